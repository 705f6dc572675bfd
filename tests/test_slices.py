"""Slices of days scored one after the other == brute force over the whole table."""

import random
from datetime import datetime, timedelta

import pytest

import bruteforce
from helpers import tx_rows
from riskloom.config import ExecConfig, RuleConfig
from riskloom.operators.slices import SliceScorer, write_by_day

D0 = datetime(2025, 10, 6)


def rows_over_days(seed, n=220):
    """Times crowd around midnights, some tie, some are missing."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        midnight = D0 + timedelta(days=rnd.choice([1, 2, 4, 5]))
        ts = midnight + timedelta(seconds=rnd.randrange(-600, 600), microseconds=rnd.choice([0, 0, 7]))
        if rnd.random() < 0.05:
            ts = None
        rows.append({"user_id": rnd.choice(["HOT"] * 4 + ["U1", "U2", None]),
                     "device_id": rnd.choice(["A", "B", "C", "D", None]), "timestamp": ts})
    return rows


def scorer_for(spark, folder, rows, dialect, minutes, exec_cfg=ExecConfig()):
    write_by_day(tx_rows(spark, rows), f"{folder}/tx", dialect)
    return SliceScorer(f"{folder}/tx", f"{folder}/out", RuleConfig(velocity_window_minutes=minutes), dialect, exec_cfg)


def expected(rows, dialect, minutes):
    """txn_id -> context, as brute force finds it over all rows."""
    numbered = [dict(r, seq=i) for i, r in enumerate(rows)]
    if dialect == "window":
        return {f"X{s:04d}": v for s, v in bruteforce.window_context(numbered, minutes).items()}
    return {f"X{s:04d}": v[1] for s, v in bruteforce.history_context(numbered, minutes).items()}


def context_of(scored, dialect):
    if dialect == "window":
        return {r.txn_id: (r.txn_count_window, r.first_seen_device) for r in scored.collect()}
    return {r.txn_id: r.r_new_device > 0 for r in scored.collect()}


@pytest.mark.parametrize("dialect", ["window", "history"])
@pytest.mark.parametrize("minutes", [7, 2 * 24 * 60 + 5])
def test_slices_equal_the_whole_table(spark, tmpdir_path, dialect, minutes):
    from riskloom.operators.scoring import scored_table

    rows = rows_over_days(5)
    s = scorer_for(spark, tmpdir_path, rows, dialect, minutes, ExecConfig(hot_key_rows=40, range_rows=15))
    days = s.days(spark)
    n = sum(s.score_days(spark, first, last) for first, last in
            [(days[0], days[1]), (days[2], days[2]), (days[3], days[-1])])
    n += s.finish(spark)
    assert n == len(rows)
    scores = s.scores(spark)
    assert context_of(scores, dialect) == expected(rows, dialect, minutes)
    # every column, against one run over everything
    whole = scored_table(tx_rows(spark, rows), s.rules, dialect)
    assert sorted(map(str, scores.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_half_written_slice_is_run_again_and_rewound(spark, tmpdir_path):
    rows = rows_over_days(6)
    s = scorer_for(spark, tmpdir_path, rows, "history", 7)
    days = s.days(spark)
    s.score_days(spark, days[0], days[1])
    # a run that wrote its scores, but died before its commit
    s.scores(spark).limit(3).write.parquet(f"{tmpdir_path}/out/scores/slice=1")
    assert s.versions(spark) == [0]
    s.score_days(spark, days[2], days[-1])
    s.finish(spark)
    assert s.scores(spark).count() == len(rows)
    assert s.rewind(spark, days[2]) == [2, 1]
    for day in days[2:]:
        s.score_days(spark, day, day)
    s.finish(spark)
    assert context_of(s.scores(spark), "history") == expected(rows, "history", 7)
    assert [r.n_rows for r in s.progress(spark).sort("version").collect()][-1] == sum(r["timestamp"] is None for r in rows)


def test_slices_come_in_order(spark, tmpdir_path):
    s = scorer_for(spark, tmpdir_path, rows_over_days(7, 60), "history", 7)
    days = s.days(spark)
    with pytest.raises(ValueError, match="not scored yet"):
        s.score_days(spark, days[1], days[2])
    with pytest.raises(ValueError, match="not scored yet"):
        s.finish(spark)
    with pytest.raises(ValueError, match="ends before"):
        s.score_days(spark, days[1], days[0])
    s.score_days(spark, days[0], days[1])
    with pytest.raises(ValueError, match="rewind"):
        s.score_days(spark, days[1], days[2])


def test_a_slice_reads_only_its_partitions(spark, tmpdir_path):
    s = scorer_for(spark, tmpdir_path, rows_over_days(8), "history", 7)
    days = s.days(spark)
    assert len(days) > 3
    read = s.read_days(spark, days[2], days[2])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert {f.split("day=")[1].split("/")[0] for f in read.selectExpr("input_file_name() f").distinct().toPandas()["f"]} \
        == {str(days[2])}
    # the context of a slice: the last window of the day before
    before = s.context(spark, days[2], None)
    files = {f.split("day=")[1].split("/")[0] for f in before.selectExpr("input_file_name() f").distinct().toPandas()["f"]}
    assert files == {str(days[2] - timedelta(days=1))}
    assert min(r.timestamp for r in before.collect()) >= datetime.combine(days[2], datetime.min.time()) - timedelta(minutes=8)


@pytest.mark.parametrize("dialect", ["window", "history"])
def test_tables_without_rows_or_times(spark, tmpdir_path, dialect):
    write_by_day(tx_rows(spark, [{}]).limit(0), f"{tmpdir_path}/tx", dialect)
    s = SliceScorer(f"{tmpdir_path}/tx", f"{tmpdir_path}/out", RuleConfig(), dialect)
    assert s.days(spark) == [] and s.scores(spark) is None and s.progress(spark) is None
    assert s.finish(spark) == 0 and s.scores(spark).count() == 0
    rows = [{"user_id": "U1", "timestamp": None, "device_id": d} for d in ("A", "B", "A")]
    s = scorer_for(spark, f"{tmpdir_path}/b", rows, dialect, 7)
    assert s.finish(spark) == 3
    assert context_of(s.scores(spark), dialect) == expected(rows, dialect, 7)
