"""Each rule at its boundaries, and every reproduced dialect difference."""

from datetime import timedelta

import pytest

from helpers import T0, minutes, tx_rows
from riskloom.config import SKEWPROOF_EXEC, ExecConfig, RuleConfig
from riskloom.operators.scoring import score

EXECS = [ExecConfig(), SKEWPROOF_EXEC]
IDS = ["windows", "skewproof"]


def _by_txn(df, *cols):
    return {r.txn_id: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("dialect", ["window", "history"])
def test_high_amount_boundaries(spark, dialect):
    amounts = [99.99, 100.0, 199.99, 200.0, float("nan"), None]
    df = tx_rows(spark, [{"amount": a, "user_id": f"U{i}"} for i, a in enumerate(amounts)])
    got = _by_txn(score(df, RuleConfig(high_amount_threshold=100.0), dialect), "r_high_amount")
    nan_points = 50 if dialect == "window" else 0  # Spark orders NaN above all numbers; Python does not
    assert [got[f"X{i:04d}"][0] for i in range(6)] == [0, 30, 30, 50, nan_points, 0]


@pytest.mark.parametrize("dialect", ["window", "history"])
def test_country_mismatch(spark, dialect):
    pairs = [("GB", "GB"), ("GB", "US"), (None, "US"), ("GB", None), ("", "US"), ("", "")]
    df = tx_rows(spark, [{"card_country": c, "ip_country": i, "user_id": f"U{n}"} for n, (c, i) in enumerate(pairs)])
    got = _by_txn(score(df, RuleConfig(), dialect), "r_country_mismatch")
    empty_counts = 40 if dialect == "window" else 0  # '' is a value for Spark, falsy for Python
    assert [got[f"X{i:04d}"][0] for i in range(6)] == [0, 40, 0, 0, empty_counts, 0]


def test_blacklist_including_empty_list(spark):
    df = tx_rows(spark, [{"merchant_mcc": m, "user_id": f"U{i}"} for i, m in enumerate([4829, 7995, 5411, None])])
    got = _by_txn(score(df, RuleConfig(), "window"), "r_blacklisted_mcc")
    assert [got[f"X{i:04d}"][0] for i in range(4)] == [25, 25, 0, 0]
    got = _by_txn(score(df, RuleConfig(blacklisted_mcc=()), "window"), "r_blacklisted_mcc")
    assert all(v == (0,) for v in got.values())


def test_night_time_hours(spark):
    times = [T0.replace(hour=0, minute=0), T0.replace(hour=4, minute=59, second=59), T0.replace(hour=5, minute=0),
             T0.replace(hour=23, minute=59), None]
    df = tx_rows(spark, [{"timestamp": t, "user_id": f"U{i}"} for i, t in enumerate(times)])
    for dialect in ("window", "history"):
        got = _by_txn(score(df, RuleConfig(), dialect), "r_night_time")
        assert [got[f"X{i:04d}"][0] for i in range(5)] == [10, 10, 0, 0, 0]


@pytest.mark.parametrize("exec_cfg", EXECS, ids=IDS)
def test_window_edge_exactly_w_minutes_is_inclusive(spark, exec_cfg):
    df = tx_rows(spark, [{"timestamp": T0}, {"timestamp": T0 + minutes(5)}, {"timestamp": T0 + minutes(10) + timedelta(microseconds=1)}])
    w = _by_txn(score(df, RuleConfig(), "window", exec_cfg), "txn_count_window")
    h = _by_txn(score(df, RuleConfig(), "history", exec_cfg), "txn_count_window")
    assert [w[f"X{i:04d}"][0] for i in range(3)] == [1, 2, 2]
    assert [h[f"X{i:04d}"][0] for i in range(3)] == [0, 1, 0]


@pytest.mark.parametrize("exec_cfg", EXECS, ids=IDS)
def test_same_second_peers(spark, exec_cfg):
    ts = [T0 + timedelta(microseconds=100_000), T0 + timedelta(microseconds=900_000),
          T0 + minutes(5) + timedelta(microseconds=950_000)]
    df = tx_rows(spark, [{"timestamp": t} for t in ts])
    w = _by_txn(score(df, RuleConfig(), "window", exec_cfg), "txn_count_window")
    h = _by_txn(score(df, RuleConfig(), "history", exec_cfg), "txn_count_window")
    assert [w[f"X{i:04d}"][0] for i in range(3)] == [2, 2, 3]
    assert [h[f"X{i:04d}"][0] for i in range(3)] == [0, 1, 0]


@pytest.mark.parametrize("exec_cfg", EXECS, ids=IDS)
def test_velocity_threshold_is_inclusive(spark, exec_cfg):
    df = tx_rows(spark, [{"timestamp": T0 + minutes(i)} for i in range(4)])
    w = _by_txn(score(df, RuleConfig(), "window", exec_cfg), "txn_count_window", "r_high_velocity")
    h = _by_txn(score(df, RuleConfig(), "history", exec_cfg), "txn_count_window", "r_high_velocity")
    assert [w[f"X{i:04d}"] for i in range(4)] == [(1, 0), (2, 0), (3, 30), (4, 30)]  # 3rd txn fires
    assert [h[f"X{i:04d}"] for i in range(4)] == [(0, 0), (1, 0), (2, 0), (3, 30)]  # 4th txn fires


@pytest.mark.parametrize("exec_cfg", EXECS, ids=IDS)
def test_new_device_first_sighting_and_ties(spark, exec_cfg):
    rows = [{"device_id": "A", "timestamp": T0},
            {"device_id": "B", "timestamp": T0 + minutes(1)},
            {"device_id": "B", "timestamp": T0 + minutes(1)},   # tie at B's first timestamp
            {"device_id": "A", "timestamp": T0 + minutes(2)}]
    df = tx_rows(spark, rows)
    w = _by_txn(score(df, RuleConfig(), "window", exec_cfg), "r_new_device")
    h = _by_txn(score(df, RuleConfig(), "history", exec_cfg), "r_new_device")
    assert [w[f"X{i:04d}"][0] for i in range(4)] == [20, 20, 20, 0]  # window: first of every pair, ties too
    assert [h[f"X{i:04d}"][0] for i in range(4)] == [0, 20, 0, 0]    # history: needs prior devices, file order


@pytest.mark.parametrize("exec_cfg", EXECS, ids=IDS)
def test_null_timestamps(spark, exec_cfg):
    rows = [{"timestamp": None}, {"timestamp": None}, {"timestamp": None}, {"timestamp": T0}]
    df = tx_rows(spark, rows)
    w = _by_txn(score(df, RuleConfig(), "window", exec_cfg), "txn_count_window", "r_new_device")
    h = _by_txn(score(df, RuleConfig(), "history", exec_cfg), "txn_count_window")
    assert [w[f"X{i:04d}"] for i in range(4)] == [(3, 20), (3, 20), (3, 20), (1, 20)]
    assert [h[f"X{i:04d}"][0] for i in range(4)] == [0, 0, 0, 0]


def test_severity_and_status_bands(spark):
    # amount 2T (50) + mismatch (40) = 90 HIGH; 50 MEDIUM; 30 LOW at threshold 30; 0 INFO
    rows = [{"amount": 200.0, "ip_country": "US", "user_id": "A"}, {"amount": 200.0, "user_id": "B"},
            {"amount": 100.0, "user_id": "C", "timestamp": T0}, {"user_id": "D"}]
    df = tx_rows(spark, rows)
    cfg = RuleConfig(high_amount_threshold=100.0, flag_threshold=30)
    got = _by_txn(score(df, cfg, "history"), "total_score", "severity", "status")
    assert [got[f"X{i:04d}"] for i in range(4)] == [
        (90, "HIGH", "FLAG"), (50, "MEDIUM", "FLAG"), (30, "LOW", "FLAG"), (0, "INFO", "OK")]


def test_zero_minute_window(spark):
    df = tx_rows(spark, [{"timestamp": T0}, {"timestamp": T0}, {"timestamp": T0 + timedelta(seconds=1)}])
    cfg = RuleConfig(velocity_window_minutes=0)
    for exec_cfg in EXECS:
        w = _by_txn(score(df, cfg, "window", exec_cfg), "txn_count_window")
        h = _by_txn(score(df, cfg, "history", exec_cfg), "txn_count_window")
        assert [w[f"X{i:04d}"][0] for i in range(3)] == [2, 2, 1]
        assert [h[f"X{i:04d}"][0] for i in range(3)] == [0, 0, 0]


def test_unknown_dialect_rejected(spark):
    with pytest.raises(ValueError):
        score(tx_rows(spark, [{}]), RuleConfig(), "other")


@pytest.mark.parametrize("exec_cfg", EXECS, ids=IDS)
def test_history_uses_wall_clock_across_dst(spark, tmpdir_path, exec_cfg):
    """Naive CSV times around the autumn clock change (Europe/London, 2025-10-26).

    The sequential scorer compares naive wall-clock datetimes: 00:50 -> 02:10 is
    80 minutes, so with a 90-minute window the later row has one earlier row.
    In real elapsed time it is 140 minutes.  The window dialect keeps Spark's
    epoch-second semantics.
    """
    import os
    from riskloom.sources import read_transactions_csv
    p = os.path.join(tmpdir_path, "dst.csv")
    with open(p, "w") as f:
        f.write("txn_id,user_id,amount,currency,card_country,ip_country,merchant_mcc,device_id,timestamp\n"
                "A,U,1,GBP,GB,GB,5411,D,2025-10-26T00:50:00\n"
                "B,U,1,GBP,GB,GB,5411,D,2025-10-26T02:10:00\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        tx = read_transactions_csv(spark, p)
        cfg = RuleConfig(velocity_window_minutes=90)
        h = _by_txn(score(tx, cfg, "history", exec_cfg), "txn_count_window")
        w = _by_txn(score(tx, cfg, "window", exec_cfg), "txn_count_window")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert h == {"A": (0,), "B": (1,)}
    assert w == {"A": (1,), "B": (1,)}


@pytest.mark.parametrize("exec_cfg", EXECS, ids=IDS)
def test_window_seconds_floor_before_1970(spark, exec_cfg):
    """Epoch seconds are floored (like CAST(ts AS BIGINT)), also for negative epochs."""
    from datetime import datetime
    t = datetime(1969, 12, 31, 23, 59, 58, 250000)       # epoch -1.75 s -> second -2
    rows = [{"timestamp": t}, {"timestamp": t + timedelta(milliseconds=700)},   # -1.05 s -> second -2 (peer)
            {"timestamp": t + timedelta(seconds=1)}]                             # -0.75 s -> second -1
    df = tx_rows(spark, rows)
    w = _by_txn(score(df, RuleConfig(velocity_window_minutes=0), "window", exec_cfg), "txn_count_window")
    assert [w[f"X{i:04d}"][0] for i in range(3)] == [2, 2, 1]
