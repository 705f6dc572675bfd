"""Ingest modes (permissive / strict / upload) and sinks."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SAMPLE_CSV
from riskloom.config import RuleConfig, parse_mcc_list
from riskloom.operators.reports import nested_results
from riskloom.operators.scoring import score
from riskloom.sources import (read_transactions_csv, read_transactions_strict, read_transactions_upload,
                              write_nested, write_scored)

HEADER = "txn_id,user_id,amount,currency,card_country,ip_country,merchant_mcc,device_id,timestamp\n"


def _csv(dirpath, body, name="in.csv"):
    p = os.path.join(dirpath, name)
    with open(p, "w") as f:
        f.write(HEADER + body)
    return p


def test_permissive_reader_nulls_bad_values(spark, tmpdir_path):
    p = _csv(tmpdir_path, "A1,U1,abc,GBP,GB,,xx,D1,not-a-time\n")
    r = read_transactions_csv(spark, p).first()
    assert r.amount is None and r.merchant_mcc is None and r.timestamp is None and r.ip_country is None
    assert r.seq is not None


def test_permissive_reader_arrival_order(spark):
    rows = read_transactions_csv(spark, SAMPLE_CSV).orderBy("seq").collect()
    assert [r.txn_id for r in rows] == [f"T00{i}" for i in range(1, 9)]


def test_strict_reader_keeps_empty_strings_and_fails_on_bad_numbers(spark, tmpdir_path):
    ok = _csv(tmpdir_path, "A1,U1,12.5,GBP,,US,5411,D1,2025-10-06T01:02:03\n", "ok.csv")
    r = read_transactions_strict(spark, ok).first()
    assert r.card_country == "" and r.amount == 12.5 and r.merchant_mcc == 5411
    # '' is falsy in the history dialect: no mismatch
    assert score(read_transactions_strict(spark, ok), RuleConfig(), "history").first().r_country_mismatch == 0
    bad = _csv(tmpdir_path, "A1,U1,oops,GBP,GB,US,5411,D1,2025-10-06T01:02:03\n", "bad.csv")
    with pytest.raises(PySparkException):
        read_transactions_strict(spark, bad).collect()
    bad_ts = _csv(tmpdir_path, "A1,U1,1.0,GBP,GB,US,5411,D1,yesterday\n", "bad_ts.csv")
    with pytest.raises(PySparkException):
        read_transactions_strict(spark, bad_ts).collect()


def test_strict_reader_requires_columns(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "short.csv")
    with open(p, "w") as f:
        f.write("txn_id,user_id\nA,B\n")
    with pytest.raises(KeyError):
        read_transactions_strict(spark, p)


def test_upload_reader_missing_values_become_text_nan(spark, tmpdir_path):
    body = ("A1,U1,10,GBP,GB,,5411,D1,2025-10-06T01:00:00\n"
            "A2,U1,NA,GBP,NA,NA,5411,D1,2025-10-06T02:00:00\n"
            "A3,U1,5,GBP,GB,N/A,5411,D1,2025-10-06T03:00:00\n")
    p = _csv(tmpdir_path, body)
    df = read_transactions_upload(spark, p)
    rows = {r.txn_id: r for r in df.collect()}
    assert rows["A1"].ip_country == "nan" and rows["A2"].card_country == "nan"
    assert rows["A2"].amount != rows["A2"].amount  # NaN
    s = {r.txn_id: r.r_country_mismatch for r in score(df, RuleConfig(), "history").collect()}
    # one side missing -> 'GB' != 'nan' fires; both missing -> 'nan' == 'nan' does not
    assert s == {"A1": 40, "A2": 0, "A3": 40}


def test_upload_reader_fails_on_missing_mcc(spark, tmpdir_path):
    p = _csv(tmpdir_path, "A1,U1,10,GBP,GB,GB,,D1,2025-10-06T01:00:00\n")
    with pytest.raises(PySparkException):
        read_transactions_upload(spark, p).collect()


def test_csv_sink_round_trip(spark, tmpdir_path):
    tx = read_transactions_csv(spark, SAMPLE_CSV)
    out = os.path.join(tmpdir_path, "fraud_scores")
    scored = score(tx, RuleConfig(), "window").drop("seq", "_us", "_key", "_usnl")
    write_scored(scored, out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 8 and "total_score" in back.columns
    write_scored(scored, out + "_pq", fmt="parquet", partition_by=["status"])
    assert spark.read.parquet(out + "_pq").count() == 8


def test_nested_sink(spark, tmpdir_path):
    cfg = RuleConfig()
    nested = nested_results(score(read_transactions_csv(spark, SAMPLE_CSV), cfg, "history"), cfg)
    out = os.path.join(tmpdir_path, "nested")
    write_nested(nested, out)
    back = spark.read.json(out)
    t2 = back.where(F.col("txn_id") == "T002").first()
    assert [h["name"] for h in t2.rules_triggered] == ["HighAmount", "BlacklistedMCC", "NightTime"]
    with pytest.raises(ValueError):
        write_nested(nested, out, fmt="csv")


def test_parse_mcc_list():
    assert parse_mcc_list("4829, 7995") == (4829, 7995)
    assert parse_mcc_list(" 1,, 2 ,") == (1, 2)
    assert parse_mcc_list("1, x", empty_on_error=True) == ()
    with pytest.raises(ValueError):
        parse_mcc_list("1, x")
    assert parse_mcc_list("") == ()


def test_upload_keeps_numeric_looking_ids_as_text(spark, tmpdir_path):
    """Ids that look numeric are not turned into numbers (007 stays 007)."""
    p = _csv(tmpdir_path, "007,0042,10,GBP,GB,GB,5411,D1,2025-10-06T01:00:00\n")
    r = read_transactions_upload(spark, p).first()
    assert (r.txn_id, r.user_id) == ("007", "0042")


def test_default_blacklist_and_parameters():
    """D13 and the documented defaults."""
    cfg = RuleConfig()
    assert cfg.blacklisted_mcc == (4829, 7995)
    assert (cfg.flag_threshold, cfg.high_amount_threshold, cfg.velocity_window_minutes,
            cfg.velocity_max_allowed) == (50, 2000.0, 5, 3)


def test_csv_sink_default_time_text_matches_committed_output(spark, tmpdir_path):
    """Default CSV sink writes Spark's default timestamp text, like the committed file."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        tx = read_transactions_csv(spark, SAMPLE_CSV)
        out = os.path.join(tmpdir_path, "fraud_scores_txt")
        write_scored(score(tx, RuleConfig(), "window").select("txn_id", "timestamp"), out)
        lines = [ln for f in sorted(os.listdir(out)) if f.endswith(".csv") for ln in open(os.path.join(out, f))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert "T001,2025-10-06T00:15:00.000+01:00\n" in lines


HEAD = "txn_id,user_id,amount,currency,card_country,ip_country,merchant_mcc,device_id,timestamp\n"


def _csv_of(tmpdir_path, *lines):
    path = f"{tmpdir_path}/in.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEAD + "".join(x + "\n" for x in lines))
    return path


@pytest.mark.parametrize("amount,time", [("1.0d", "2025-10-06T10:00:00"), ("1", "10:15"), ("1", "2025"),
                                         ("1", "2025-10")])
def test_strict_reader_rejects_what_python_rejects(spark, tmpdir_path, amount, time):
    from riskloom.sources.csv import read_transactions_strict

    df = read_transactions_strict(spark, _csv_of(tmpdir_path, f"T1,U1,{amount},GBP,GB,GB,5411,D1,{time}"))
    with pytest.raises(Exception):
        df.count()
    with pytest.raises(Exception):
        df.select("txn_id").collect()


def test_strict_reader_reads_doubled_quotes_and_line_breaks(spark, tmpdir_path):
    from riskloom.sources.csv import read_transactions_strict

    path = _csv_of(tmpdir_path, 'T1,"U ""x"", y",1_0.5,GBP,GB,GB,5411,"D\n1",2025-10-06 10:00:00')
    r = read_transactions_strict(spark, path).first()
    assert (r.user_id, r.device_id, r.amount) == ('U "x", y', "D\n1", 10.5)


def test_numbers_as_python_prints_them(spark):
    import json

    from pyspark.sql import functions as F

    from riskloom.functions.text import json_double, money

    values = [0.0, 1.5, -2.25, 1e7, 12345678.5, 123456789012345.6, 1e16, 1.5e17, 1e-3, 0.0005, 1e-4, 1.25e-5, 1e300,
              float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: (r.j, r.m) for r in df.select("i", json_double(F.col("v")).alias("j"), money(F.col("v")).alias("m")).collect()}
    for i, v in enumerate(values):
        assert got[i][0] == json.dumps(v)
        if abs(v) < 1e12 or v != v:
            assert got[i][1] == "${:,.2f}".format(v)


def test_times_keep_their_offset(spark, tmpdir_path):
    """Aware times: ordered by instant, hour and text by their own wall clock, through rules, texts and the CSV sink."""
    from riskloom.config import RuleConfig
    from riskloom.operators import reports as P
    from riskloom.operators.scoring import score, scored_table
    from riskloom.sources import read_transactions_strict, write_scored

    times = ["2025-01-01T23:30:00+02:00", "2025-01-01T21:31:00Z", "2025-01-02T03:02:00+05:30", "2025-01-01T12:33:00.5-09:00"]
    path = f"{tmpdir_path}/in.csv"
    with open(path, "w") as f:
        f.write("txn_id,user_id,amount,currency,card_country,ip_country,merchant_mcc,device_id,timestamp\n")
        f.writelines(f"T{k},U,1,GBP,GB,GB,5411,D,{t.replace('.5-', '.500-')}\n" for k, t in enumerate(times))
    tx = read_transactions_strict(spark, path)
    cfg = RuleConfig(velocity_window_minutes=5, velocity_max_allowed=3)
    flat = {r.txn_id: r for r in P.flat_detailed(score(tx, cfg, "history"), cfg).collect()}
    texts = [flat[f"T{k}"].timestamp for k in range(4)]
    assert texts == ["2025-01-01T23:30:00+02:00", "2025-01-01T21:31:00+00:00", "2025-01-02T03:02:00+05:30",
                     "2025-01-01T12:33:00.500000-09:00"]
    assert [flat[f"T{k}"].rules_triggered for k in range(3)] == ["", "", "NightTime (+10) [Transaction at 03:00]"]
    assert flat["T3"].score == 30          # the fourth within five minutes, by the instants
    out = f"{tmpdir_path}/out"
    write_scored(scored_table(tx, cfg, "history"), out)
    assert sorted(r.timestamp for r in spark.read.option("header", True).csv(out).collect()) == sorted(texts)


def test_quoted_line_breaks_in_many_splits(spark, tmpdir_path):
    """Small splits, quotes over several lines and splits: the rows of Python's csv module, numbered in path order."""
    import csv as pycsv
    import os
    import random

    from riskloom.schema import TRANSACTION_COLUMNS
    from riskloom.sources import csv as S

    rnd = random.Random(3)
    want, src = [], f"{tmpdir_path}/src"
    os.makedirs(src)
    for n in (2, 0, 1):
        with open(f"{src}/part-{n}.csv", "w", newline="") as f:
            w = pycsv.writer(f, lineterminator="\r\n" if n == 1 else "\n")
            w.writerow(TRANSACTION_COLUMNS)
            for k in range(120):
                device = rnd.choice(["plain", 'say "hi"', "two\nlines", "a,\n\n\"b\"\n" * rnd.randint(1, 9), ""])
                row = [f"F{n}-{k}", "U", "1.5", "GBP", "GB", "GB", "5411", device, "2025-01-01T10:00:00"]
                w.writerow(row)
                want.append((n, k, device))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(src).rdd.getNumPartitions() > 10
        got = S.read_transactions_strict(spark, src).orderBy("seq").collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    want.sort()
    assert [(r.txn_id, r.device_id) for r in got] == [(f"F{n}-{k}", d) for n, k, d in want]
    assert [r.seq for r in got] == list(range(360))
