"""Skew-proof strategy == per-user windows == brute force, on skewed random fixtures."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import bruteforce
from helpers import T0, tx_rows
from riskloom.config import ExecConfig, RuleConfig
from riskloom.operators.context import with_context
from riskloom.operators.prefix import probe_prefix_counts, sorted_pass


def skewed_rows(seed, n=400):
    rnd = random.Random(seed)
    users = ["HOT"] * 8 + ["U1", "U2", "U3", "U4", "U5", None, "U6", "U7"]  # HOT ~ half the rows
    base_times = [T0 + timedelta(seconds=rnd.randrange(0, 4 * 3600)) for _ in range(60)]
    rows = []
    for _ in range(n):
        r = rnd.random()
        if r < 0.04:
            ts = None
        elif r < 0.35:
            ts = rnd.choice(base_times)  # many exact ties
        else:
            ts = T0 + timedelta(microseconds=rnd.randrange(0, 4 * 3600 * 10**6))
        rows.append({"user_id": rnd.choice(users), "device_id": rnd.choice(["A", "B", "C", None]),
                     "timestamp": ts})
    return rows


def _with_seq(rows):
    return [dict(r, seq=i) for i, r in enumerate(rows)]


STRATEGIES = {
    "windows": ExecConfig(),
    "skewproof": ExecConfig(hot_key_rows=0),
    "hybrid": ExecConfig(hot_key_rows=30),        # HOT (and the NULL user?) go skew-proof, others windows
    "ranges": ExecConfig(hot_key_rows=0, range_rows=12),          # many ranges a user, some of them dense
    "ranges_dense": ExecConfig(hot_key_rows=0, range_rows=1),     # nearly every range is dense
    "ranges_shuffled": ExecConfig(hot_key_rows=0, range_rows=5, max_broadcast_keys=0),
    "hybrid_tiny_broadcast": ExecConfig(hot_key_rows=30, max_broadcast_keys=0),  # hot keys via shuffle join
}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("strategy", list(STRATEGIES))
def test_window_dialect_against_bruteforce(spark, seed, strategy):
    rows = skewed_rows(seed)
    df = tx_rows(spark, rows)
    cfg = RuleConfig(velocity_window_minutes=7)
    got = {r.seq: (r.txn_count_window, r.first_seen_device)
           for r in with_context(df, cfg, "window", STRATEGIES[strategy]).collect()}
    want = bruteforce.window_context(_with_seq(rows), 7)
    assert got == want


@pytest.mark.parametrize("seed", [1, 3])
@pytest.mark.parametrize("strategy", list(STRATEGIES))
def test_history_dialect_against_bruteforce(spark, seed, strategy):
    rows = skewed_rows(seed)
    df = tx_rows(spark, rows)
    cfg = RuleConfig(velocity_window_minutes=7)
    got = {r.seq: (r.txn_count_window, r._new_device)
           for r in with_context(df, cfg, "history", STRATEGIES[strategy]).collect()}
    want = bruteforce.history_context(_with_seq(rows), 7)
    assert got == want


def test_prefix_counts_across_many_partitions(spark):
    rnd = random.Random(7)
    pts = [(rnd.choice(["g1"] * 6 + ["g2", None]), rnd.randrange(0, 50), i) for i in range(300)]
    prb = [(rnd.choice(["g1", "g2", None, "g3"]), rnd.randrange(-5, 55), i, s) for i in range(120) for s in (1, -1)]
    p_df = spark.createDataFrame(pts, "g string, k long, seq long")
    q_df = spark.createDataFrame(prb, "g string, k long, seq long, sign int")
    got = {(r.seq, r.sign): r.below for r in probe_prefix_counts(p_df, q_df, num_partitions=13).collect()}
    want = {(seq, s): sum(1 for (pg, pk, _) in pts if pg == g and pk < k) for (g, k, seq, s) in prb}
    assert got == want


def test_prefix_plan_has_no_per_group_exchange(spark):
    p_df = spark.createDataFrame([("a", 1, 0)], "g string, k long, seq long")
    q_df = spark.createDataFrame([("a", 2, 0, 1)], "g string, k long, seq long, sign int")
    plan = sorted_pass(p_df, q_df, 4)._jdf.queryExecution().executedPlan().toString()
    plan = plan.lower()
    assert "rangepartitioning" in plan
    assert "hashpartitioning" not in plan  # data and probe rows are never hash-partitioned by group


def test_hot_key_broadcast_is_bounded(spark):
    # with more hot keys than the broadcast bound, the plan must not broadcast them
    rows = skewed_rows(5, n=200)
    df = tx_rows(spark, rows)
    out = with_context(df, RuleConfig(), "history", ExecConfig(hot_key_rows=1, max_broadcast_keys=2))
    assert out.count() == 200
    assert out.where(F.col("txn_count_window").isNull()).count() == 0
    assert isinstance(out.schema["txn_count_window"].dataType, T.LongType)


@pytest.mark.parametrize("batch_rows", [1, 3, 7])
def test_prefix_counts_with_tiny_arrow_batches(spark, batch_rows):
    """Groups that continue across Arrow batches and across partitions."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    try:
        rnd = random.Random(batch_rows)
        pts = [(rnd.choice(["a"] * 5 + ["b", None]), rnd.randrange(0, 30), i) for i in range(150)]
        prb = [(rnd.choice(["a", "b", None, "c"]), rnd.randrange(-2, 33), i, s) for i in range(60) for s in (1, -1)]
        p_df = spark.createDataFrame(pts, "g string, k long, seq long")
        q_df = spark.createDataFrame(prb, "g string, k long, seq long, sign int")
        got = {(r.seq, r.sign): r.below for r in probe_prefix_counts(p_df, q_df, num_partitions=5).collect()}
        want = {(seq, s): sum(1 for (pg, pk, _) in pts if pg == g and pk < k) for (g, k, seq, s) in prb}
        assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_hot_threshold_is_relative_to_partition_size(spark):
    """Same result whichever way the relative rule routes; it only raises the threshold."""
    rows = skewed_rows(9, n=300)
    df = tx_rows(spark, rows)
    cfg = RuleConfig(velocity_window_minutes=7)
    want = bruteforce.history_context(_with_seq(rows), 7)
    for factor in (0.0, 4.0, 1000.0):
        ex = ExecConfig(hot_key_rows=20, hot_partition_factor=factor)
        got = {r.seq: (r.txn_count_window, r._new_device)
               for r in with_context(df, cfg, "history", ex, rows_upper_bound=300).collect()}
        assert got == want


@pytest.mark.parametrize("max_keys,hot_rows", [(10_000, 0), (2, 10_000), (3, 25), (0, 25)],
                         ids=["broadcast_all", "shuffle_no_hot", "hot_split", "too_many_hot"])
def test_attach_group_aggregates_every_branch(spark, max_keys, hot_rows):
    from riskloom.operators.joins import attach_group_aggregates
    rnd = random.Random(4)
    rows = [(rnd.choice(["H"] * 10 + ["a", "b", "c", None]), rnd.choice(["x", "y", None]), rnd.randrange(100), i)
            for i in range(300)]
    df = spark.createDataFrame(rows, "u string, d string, v long, seq long")
    ex = ExecConfig(hot_key_rows=hot_rows, max_broadcast_keys=max_keys)
    out = attach_group_aggregates(df, ["u", "d"], {"mx": F.max("v"), "n": F.count(F.lit(1))}, ex)
    got = {r.seq: (r.mx, r.n) for r in out.collect()}
    want = {}
    for (u, d, _, seq) in rows:
        grp = [v for (u2, d2, v, _) in rows if u2 == u and d2 == d]
        want[seq] = (max(grp), len(grp))
    assert got == want


def test_strategies_agree_on_repeated_and_missing_seq(spark):
    """NULL and repeated ``seq``: the same rows from windows and from the skew-proof path."""
    from collections import Counter

    from riskloom.config import DEFAULT_EXEC, SKEWPROOF_EXEC, RuleConfig
    from riskloom.operators.scoring import scored_table
    from tests.helpers import minutes, T0, tx_rows

    rows = [{"seq": s, "timestamp": T0 + minutes(i), "device_id": f"D{i % 2}"}
            for i, s in enumerate([0, 1, 1, None, 4])]
    tx = tx_rows(spark, rows)
    for dialect in ("window", "history"):
        a, b = (Counter(scored_table(tx, RuleConfig(), dialect, ex).collect())
                for ex in (DEFAULT_EXEC, SKEWPROOF_EXEC))
        assert a == b and sum(a.values()) == 5


def test_hot_threshold_has_an_absolute_ceiling():
    from riskloom.config import ExecConfig

    assert ExecConfig().hot_key_ceiling >= ExecConfig().hot_key_rows


def test_no_local_intermediates_on_a_cluster():
    from riskloom.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    import pytest
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


@pytest.mark.parametrize("dialect", ["window", "history"])
@pytest.mark.parametrize("window_minutes", [0, 1, 600])
def test_ranges_with_empty_short_and_whole_windows(spark, dialect, window_minutes):
    """Windows of nothing, of less than a range and of more than the user's whole span; one time for all of a user."""
    rows = skewed_rows(11, n=150) + [{"user_id": "ONE", "device_id": "A", "timestamp": T0}] * 40
    rows += [{"user_id": "NEVER", "device_id": "A", "timestamp": None}] * 5
    want_of = bruteforce.window_context if dialect == "window" else bruteforce.history_context
    want = {s: v[0] for s, v in want_of(_with_seq(rows), window_minutes).items()}
    for size in (4, 1000):
        out = with_context(tx_rows(spark, rows), RuleConfig(velocity_window_minutes=window_minutes), dialect,
                           ExecConfig(hot_key_rows=0, range_rows=size))
        assert {r.seq: r.txn_count_window for r in out.collect()} == want


def test_ranges_take_one_exchange_by_user_and_range(spark):
    """No range is dense: one exchange of the rows, no Python, no join of rows with rows."""
    rows = skewed_rows(3, n=200)
    out = with_context(tx_rows(spark, rows), RuleConfig(velocity_window_minutes=1), "history",
                       ExecConfig(hot_key_rows=0, range_rows=60))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "__range" in plan
    assert "Python" not in plan and "InArrow" not in plan and "SortMergeJoin" not in plan


def test_empty_table_takes_the_ranges(spark):
    empty = tx_rows(spark, [{}]).limit(0)
    for dialect in ("window", "history"):
        assert with_context(empty, RuleConfig(), dialect, ExecConfig(hot_key_rows=0)).count() == 0
