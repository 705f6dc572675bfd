"""The micro-batch scorer: equal to batch, lossless, safe to repeat, splitting hot users."""

import math
import random
from datetime import timedelta

import pytest

from helpers import NTZ_SCHEMA, T0
from riskloom.config import ExecConfig, RuleConfig
from riskloom.operators.scoring import scored_table
from riskloom.streaming import BatchScorer

CFG = RuleConfig(velocity_window_minutes=30, high_amount_threshold=100.0)


def some_rows(n=200, seed=11, nulls=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = T0 + timedelta(seconds=rnd.randrange(0, 6 * 3600), microseconds=rnd.choice([0, 7, 500_000]))
        if nulls and rnd.random() < .03:
            ts = None
        amount = rnd.choice([float(rnd.randrange(1, 300)), float("nan"), None])
        user = "HOT" if rnd.random() < .5 else rnd.choice(["U1", "U2", None])
        rows.append((f"S{i % 150}", user, amount, "GBP", "GB", rnd.choice(["GB", "US", None]),
                     rnd.choice([5411, 4829, None]), rnd.choice(["A", "B", "C", None]), ts, i))
    tied = next(r for r in rows if r[8])
    return rows + [("tie", tied[1], 1.0, "GBP", "GB", "GB", 5411, "Z", tied[8], n)]


def stream_of(spark, rows, src, n_files, shuffle=True):
    rows = rows[:]
    if shuffle:
        random.Random(3).shuffle(rows)
    size = -(-len(rows) // n_files)
    for k in range(n_files):
        spark.createDataFrame(rows[k * size:(k + 1) * size], NTZ_SCHEMA).coalesce(1).write.parquet(f"{src}/f{k:03d}")
    return (spark.readStream.schema(NTZ_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(src))


def same(a, b):
    def key(r):
        return tuple("NaN" if isinstance(v, float) and math.isnan(v) else repr(v) for v in r)
    return sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


@pytest.mark.parametrize("dialect", ["history", "window"])
def test_equal_to_batch_with_nulls_and_a_split_hot_user(spark, tmpdir_path, dialect):
    rows = some_rows(seed=5)
    scorer = BatchScorer(f"{tmpdir_path}/state", CFG, dialect, delay_seconds=7 * 3600,
                         exec_cfg=ExecConfig(hot_key_rows=20, hot_partition_factor=0))
    scorer.start(stream_of(spark, rows, f"{tmpdir_path}/src", 4)).awaitTermination()
    scorer.flush(spark)
    scorer.flush(spark)      # a second end of input changes nothing
    assert same(scorer.scores(spark), scored_table(spark.createDataFrame(rows, NTZ_SCHEMA), CFG, dialect))
    assert scorer.late_rows(spark) is None
    assert scorer.progress(spark).selectExpr("sum(n_in)", "sum(n_out)").first() == (len(rows), len(rows))


@pytest.mark.parametrize("dialect", ["history", "window"])
def test_rows_leave_as_the_frontier_passes(spark, tmpdir_path, dialect):
    """Files in time order: most rows are final before the end, state stays small, merged sightings still count."""
    from riskloom.streaming import batches

    rows = sorted(some_rows(160, 9, nulls=False), key=lambda r: (r[8], r[9]))
    scorer = BatchScorer(f"{tmpdir_path}/state", CFG, dialect, delay_seconds=5)
    old, batches.MERGE_EVERY = batches.MERGE_EVERY, 2
    try:
        scorer.start(stream_of(spark, rows, f"{tmpdir_path}/src", 6, shuffle=False)).awaitTermination()
        assert scorer.scores(spark).count() > len(rows) * 0.9
        assert len(scorer._folders(spark, "pending")) <= 2
        scorer.flush(spark)
    finally:
        batches.MERGE_EVERY = old
    assert same(scorer.scores(spark), scored_table(spark.createDataFrame(rows, NTZ_SCHEMA), CFG, dialect))


def test_half_written_batch_is_run_again(spark, tmpdir_path, monkeypatch):
    rows = some_rows(90, 4)
    scorer = BatchScorer(f"{tmpdir_path}/state", CFG, delay_seconds=7 * 3600)
    tx = stream_of(spark, rows, f"{tmpdir_path}/src", 3)
    commit, calls = BatchScorer._commit, []

    def fails_once(self, facts, version):
        calls.append(version)
        if len(calls) == 2:
            raise RuntimeError("killed before the commit")
        commit(self, facts, version)

    monkeypatch.setattr(BatchScorer, "_commit", fails_once)
    with pytest.raises(Exception, match="killed before the commit"):
        scorer.start(tx).awaitTermination()
    scorer.start(tx).awaitTermination()      # restart from the checkpoint
    scorer.step(spark.createDataFrame(rows[:5], NTZ_SCHEMA), 0)      # a committed batch is left alone
    scorer.flush(spark)
    assert calls[1] == calls[2]
    assert same(scorer.scores(spark), scored_table(spark.createDataFrame(rows, NTZ_SCHEMA), CFG, "history"))


def test_late_rows_are_kept_apart_and_counted(spark, tmpdir_path):
    scorer = BatchScorer(f"{tmpdir_path}/state", CFG, delay_seconds=60)
    rows = sorted(some_rows(60, 8, nulls=False), key=lambda r: (r[8], r[9]))
    late = ("LATE", "U1", None, "GBP", None, "GB", 5411, "A", T0 - timedelta(days=1), 999)
    scorer.step(spark.createDataFrame(rows, NTZ_SCHEMA), 0)
    scorer.step(spark.createDataFrame([late], NTZ_SCHEMA), 1)
    scorer.step(spark.createDataFrame([], NTZ_SCHEMA), 2)
    scorer.flush(spark)
    assert [r.txn_id for r in scorer.late_rows(spark).collect()] == ["LATE"]
    assert same(scorer.scores(spark), scored_table(spark.createDataFrame(rows, NTZ_SCHEMA), CFG, "history"))
    total = scorer.progress(spark).selectExpr("sum(n_in)", "sum(n_late)", "sum(n_out)").first()
    assert total == (len(rows) + 1, 1, len(rows))
