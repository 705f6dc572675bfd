"""Hypothesis: random transaction sets, both dialects, both strategies == brute force."""

from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import bruteforce
from helpers import T0, tx_rows
from riskloom.config import ExecConfig, RuleConfig
from riskloom.operators.context import with_context

row = st.fixed_dictionaries({
    "user_id": st.sampled_from(["A", "B", None]),
    "device_id": st.sampled_from(["d1", "d2", "d3", None]),
    # few distinct instants -> many exact ties and same-second peers; None = NULL time
    "timestamp": st.one_of(st.none(), st.integers(0, 40).map(lambda s: T0 + timedelta(seconds=s * 15)),
                           st.integers(0, 600_000_000).map(lambda us: T0 + timedelta(microseconds=us))),
})


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40), minutes=st.integers(0, 4),
       skewproof=st.booleans())
def test_context_matches_bruteforce(spark, rows, minutes, skewproof):
    df = tx_rows(spark, rows)
    cfg = RuleConfig(velocity_window_minutes=minutes)
    exec_cfg = ExecConfig(hot_key_rows=0) if skewproof else ExecConfig()
    seq_rows = [dict(r, seq=i) for i, r in enumerate(rows)]
    got_w = {r.seq: (r.txn_count_window, r.first_seen_device)
             for r in with_context(df, cfg, "window", exec_cfg).collect()}
    assert got_w == bruteforce.window_context(seq_rows, minutes)
    got_h = {r.seq: (r.txn_count_window, r._new_device)
             for r in with_context(df, cfg, "history", exec_cfg).collect()}
    assert got_h == bruteforce.history_context(seq_rows, minutes)
