"""Durable replies, the blacklist as a table, rejects, path order and the published sink."""

import os
import uuid
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import T0, tx_rows
from riskloom.config import RuleConfig
from riskloom.functions import text as X
from riskloom.operators import explain as E
from riskloom.operators.blacklist import LISTED, merged_intervals, with_listed
from riskloom.operators.replies import ReplyTable, _asking, answer
from riskloom.operators.scoring import score, scored_table
from riskloom.sources import (publish_scored, read_published, read_transactions_checked, read_transactions_csv,
                              read_transactions_strict)
from riskloom.sources.sinks import CSV_MICROS_OPTIONS, published_versions

HEADER = "txn_id,user_id,amount,currency,card_country,ip_country,merchant_mcc,device_id,timestamp\n"
CODES = "mcc int, valid_from timestamp_ntz, valid_to timestamp_ntz"


def noting(folder, answer_of=lambda r: f"about {r['prompt']}"):
    """A function that leaves one file a call, so that calls in any worker can be counted."""
    def call(record):
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(record["prompt"])
        return answer_of(record)
    return call


def asked(folder):
    return sorted(open(os.path.join(folder, n)).read() for n in os.listdir(folder))


def test_each_distinct_prompt_is_asked_once_over_runs(spark, tmpdir_path):
    table = ReplyTable.fresh(spark, flush_every=3)
    rows = spark.range(60).select("id", F.concat(F.lit("p"), (F.col("id") % 7).cast("string")).alias("prompt"))
    for _ in range(2):
        got = {r.id: r.reply for r in answer(rows, noting(tmpdir_path), "none", table, key_col="id").collect()}
        assert got == {i: f"about p{i % 7}" for i in range(60)}
    assert asked(tmpdir_path) == [f"p{i}" for i in range(7)]
    more = rows.unionByName(spark.createDataFrame([(99, "new"), (100, None)], "id long, prompt string"))
    assert answer(more.where("prompt is not null"), noting(tmpdir_path), "none", table).count() == 61
    assert asked(tmpdir_path) == ["new"] + [f"p{i}" for i in range(7)]


def test_a_repeated_task_asks_only_what_was_lost(tmpdir_path):
    table = ReplyTable(f"file://{tmpdir_path}/replies", concurrency=2, flush_every=2)
    notes = os.path.join(tmpdir_path, "notes")
    os.mkdir(notes)
    rows = pd.DataFrame({"prompt_key": [f"ab{i}" for i in range(10)], "bucket": "ab",
                         "prompt": [f"q{i}" for i in range(10)]})
    call = noting(notes)

    class Killed(BaseException):
        pass

    def dies(record):
        if record["prompt"] == "q6":
            raise Killed
        return call(record)

    with pytest.raises(Killed):
        list(_asking(table, dies)(iter([rows])))
    before = asked(notes)
    assert set(before) >= {f"q{i}" for i in range(6)} and "q6" not in before
    again = list(_asking(table, call)(iter([rows])))
    # the chunk that was under way is asked again, nothing that had been written is
    assert sum(f["asked"].sum() for f in again) == 4
    assert all(asked(notes).count(f"q{i}") == 1 for i in range(6))
    assert sum(f["asked"].sum() for f in _asking(table, call)(iter([rows]))) == 0


def test_failed_calls_get_the_fallback_and_are_asked_again(spark, tmpdir_path):
    table = ReplyTable.fresh(spark)
    rows = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "none")], "id long, prompt string")

    def call(record):
        if record["prompt"] == "bad":
            raise RuntimeError("down")
        return None if record["prompt"] == "none" else " fine "
    got = {r.id: r.reply for r in answer(rows, call, "fallback", table).collect()}
    assert got == {1: "fine", 2: "fallback", 3: "fallback"}
    got = {r.id: r.reply for r in answer(rows, lambda r: "now", "fallback", table).collect()}
    assert got == {1: "fine", 2: "now", 3: "now"}
    assert answer(rows.limit(0), call, "fallback", table).count() == 0


def test_explanations_and_summary_through_the_reply_table(spark, tmpdir_path):
    cfg = RuleConfig(high_amount_threshold=100.0)
    rows = [{"amount": 5000.0, "ip_country": "US", "user_id": f"U{i}"} for i in range(4)] + [
        {"txn_id": "X0000", "user_id": "V", "timestamp": T0 + timedelta(hours=1)}]
    s = score(tx_rows(spark, rows), cfg, "history")
    table = ReplyTable.fresh(spark)
    call = noting(tmpdir_path, E.template_explainer)
    for _ in range(2):
        out = E.explained_table(s, cfg, call, table)
        plain = E.explained_table(s, cfg)
        assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert len(asked(tmpdir_path)) == 4
    got = E.summarise(s, top_n=3).first()
    assert (got.n_flagged_sample, got.summary) == (3, "3 flagged transactions of 3 users, scores 90 to 90.")

    def fails(_):
        raise RuntimeError("down")
    assert E.summarise(s, fails).first().summary == X.EXPLANATION_FALLBACK
    assert E.summarise(s.where("false"), fails).first().summary == X.NO_FLAGGED_TEXT


def _listed(times, code, t):
    return code is not None and any(m == code and (a is None or (t is not None and a <= t)) and (b is None or (t is not None and t < b))
               for m, a, b in times if not (a is not None and b is not None and a >= b))


@pytest.mark.parametrize("bound", [0, 1000])
def test_blacklist_table_equals_brute_force(spark, bound):
    from riskloom.config import DEFAULT_EXEC

    def h(n):
        return None if n is None else T0 + timedelta(hours=n)

    codes = [(1, h(0), h(3)), (1, h(2), h(5)), (1, h(2), h(5)), (1, h(5), h(6)), (1, h(9), None), (1, h(20), h(21)),
             (2, None, h(1)), (2, h(4), h(4)), (2, h(7), h(6)), (3, None, None), (None, None, None), (4, None, h(2)),
             (4, h(1), h(3)), (4, h(8), h(9))]
    times = spark.createDataFrame(codes, CODES)
    rows = [{"merchant_mcc": m, "timestamp": h(t)} for m in (1, 2, 3, 4, 5, None)
            for t in (-1, 0, 1, 2, 3, 4, 4.5, 5, 6, 8, 9, 20, 25, None)]
    tx = tx_rows(spark, rows)
    out = with_listed(tx, times, DEFAULT_EXEC.with_(max_broadcast_dim_rows=bound))
    assert out.columns == tx.columns + [LISTED]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (bound > 0) or bound == 0
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r[LISTED] == _listed(codes, r.merchant_mcc, r.timestamp), r
    sizes = {r["__mcc"]: r.n for r in merged_intervals(times).select("__mcc", F.size("__valid").alias("n")).collect()}
    assert sizes == {1: 2, 2: 1, 3: 1, 4: 2}
    # in scoring it takes the place of the literal list; a list without validity columns always holds
    s = score(tx, RuleConfig(blacklisted_mcc=(5,)), "history", blacklist=times.select("mcc"))
    assert {r.merchant_mcc for r in s.where("r_blacklisted_mcc > 0").collect()} == {1, 2, 3, 4}
    assert LISTED not in s.columns


def test_checked_reader_splits_rows_and_rejects(spark, tmpdir_path):
    good = ["A1,U1,1.5,GBP,GB,,5411,D1,2025-10-06T01:02:03", 'A2,"U, 2",,GBP,GB,US,,D1,']
    bad = {"B1,U1,abc,GBP,GB,GB,5411,D1,2025-10-06T01:02:03": "amount",
           "B2,U1,1.0,GBP,GB,GB,x,D1,2025-10-06T01:02:03": "merchant_mcc",
           "B3,U1,1.0,GBP,GB,GB,5411,D1,soon": "timestamp", "B4,U1,1.0": "fields",
           'B5,"U,1",1.0,GBP,GB,GB,5411,D1,2025-10-06T01:02:03,more': "fields"}
    with open(os.path.join(tmpdir_path, "in.csv"), "w") as f:
        f.write(HEADER + "\n".join([good[0], *bad, good[1]]) + "\n")
    typed, rejects = read_transactions_checked(spark, tmpdir_path)
    assert sorted(r.txn_id for r in typed.collect()) == ["A1", "A2"]
    assert {r.raw: r.reason for r in rejects.collect()} == bad
    assert all(r.file.endswith("in.csv") for r in rejects.collect())
    seqs = [r.seq for r in typed.select("seq").union(rejects.select("seq")).collect()]
    assert len(set(seqs)) == len(good) + len(bad)


def test_rows_of_many_files_are_numbered_like_one(spark, tmpdir_path):
    names, n = list(range(10)), 0
    for k in names[::-1]:            # written last to first, and of different sizes
        with open(os.path.join(tmpdir_path, f"f{k}.csv"), "w") as f:
            f.write(HEADER)
            for j in range((k * 7) % 13):
                f.write(f"{k:02d}-{j:02d},U,1.0,GBP,GB,GB,5411,D,2025-10-06T01:02:03\n")
                n += 1
    for read in (read_transactions_csv, read_transactions_strict):
        got = read(spark, tmpdir_path, in_path_order=True).collect()
        assert [r.txn_id for r in sorted(got, key=lambda r: r.seq)] == sorted(r.txn_id for r in got)
        assert sorted(r.seq for r in got) == list(range(n))


def test_path_order_within_a_file_read_in_splits(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "big.csv"), "w") as f:
        f.write(HEADER + "".join(f"{i:06d},U,1.0,GBP,GB,GB,5411,D,2025-10-06T01:02:03\n" for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.csv(tmpdir_path).rdd.getNumPartitions() > 3
        got = read_transactions_csv(spark, tmpdir_path, in_path_order=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(int(r.txn_id) == r.seq for r in got) and len(got) == 4000


def test_published_sink_counts_on_the_write_and_replaces_in_one_step(spark, tmpdir_path):
    path = f"file://{tmpdir_path}/scores"
    cfg = RuleConfig(high_amount_threshold=100.0)

    def wide(n):
        return scored_table(tx_rows(spark, [{"amount": 5000.0, "ip_country": "US"}] * n + [{"user_id": "Q"}]), cfg, "window")

    with pytest.raises(FileNotFoundError):
        read_published(spark, path, wide(1).schema)
    assert publish_scored(wide(3), path, options=CSV_MICROS_OPTIONS) == {"total": 4, "flagged": 3, "ok": 1}
    first = read_published(spark, path, wide(1).schema, options=CSV_MICROS_OPTIONS)
    broken = wide(2).withColumn("status", F.when(F.col("user_id") == "Q", F.raise_error(F.lit("lost"))).otherwise(
        F.col("status")))
    with pytest.raises(Exception):
        publish_scored(broken, path, options=CSV_MICROS_OPTIONS)
    assert read_published(spark, path, wide(1).schema, options=CSV_MICROS_OPTIONS).count() == 4
    assert publish_scored(wide(5), path, options=CSV_MICROS_OPTIONS)["total"] == 6
    assert first.count() == 4            # readers of the version before are not disturbed
    assert publish_scored(wide(0).where("false"), path, options=CSV_MICROS_OPTIONS) == {
        "total": 0, "flagged": 0, "ok": 0}
    assert read_published(spark, path, wide(1).schema, options=CSV_MICROS_OPTIONS).count() == 0
    assert [n for n, _ in published_versions(spark, path)] == [2, 3]


def test_stream_opens_the_code_table_for_every_batch(spark, tmpdir_path):
    from riskloom.streaming import BatchScorer

    lists = [[(5411, None, None)], [(4829, None, None)], []]
    opened = []

    def table(s):
        opened.append(len(opened))
        return s.createDataFrame(lists[min(opened[-1], 2)], CODES)

    scorer = BatchScorer(f"{tmpdir_path}/stream", RuleConfig(), blacklist=table)
    rows = [{"merchant_mcc": m, "timestamp": T0 + timedelta(minutes=k)} for k, m in enumerate((5411, 4829, 5411, 4829))]
    tx = tx_rows(spark, rows)
    scorer.step(tx.where("seq < 2"), 0)
    scorer.step(tx.where("seq >= 2"), 1)
    scorer.flush(spark)
    got = {r.txn_id: r.r_blacklisted_mcc for r in scorer.scores(spark).collect()}
    assert got == {"X0000": 25, "X0001": 0, "X0002": 0, "X0003": 25} and len(opened) == 3
