"""Per-row Python oracles for the two dialects, written from the semantics table.

Deliberately naive (quadratic): they define the expected values for the
Spark plans on small fixtures.
"""

from __future__ import annotations

import calendar
from collections import defaultdict
from datetime import datetime


def _epoch_us(ts: datetime) -> int:
    return calendar.timegm(ts.timetuple()) * 1_000_000 + ts.microsecond


def window_context(rows, window_minutes):
    """rows: dicts with seq, user_id, device_id, timestamp (naive UTC or None).

    -> {seq: (txn_count_window, first_seen_device)}"""
    w = window_minutes * 60
    out = {}
    for r in rows:
        mates = [x for x in rows if x["user_id"] == r["user_id"]]
        if r["timestamp"] is None:
            cnt = sum(1 for x in mates if x["timestamp"] is None)
            first = None
        else:
            sec = _epoch_us(r["timestamp"]) // 1_000_000
            cnt = sum(1 for x in mates if x["timestamp"] is not None
                      and sec - w <= _epoch_us(x["timestamp"]) // 1_000_000 <= sec)
            pair = [x["timestamp"] for x in mates if x["device_id"] == r["device_id"] and x["timestamp"] is not None]
            first = min(pair)
        out[r["seq"]] = (cnt, first)
    return out


def history_context(rows, window_minutes):
    """-> {seq: (prior_count, is_new_device)}; NULL times sort last, ties by seq."""
    w = window_minutes * 60_000_000
    order = sorted(rows, key=lambda r: (r["timestamp"] is None, r["timestamp"] or datetime.min, r["seq"]))
    hist = defaultdict(list)
    devices = defaultdict(set)
    out = {}
    for r in order:
        u = r["user_id"]
        if r["timestamp"] is None:
            cnt = 0
        else:
            t = _epoch_us(r["timestamp"])
            cnt = sum(1 for x in hist[u] if x is not None and t - w <= x < t)
        seen = devices[u]
        out[r["seq"]] = (cnt, bool(seen) and r["device_id"] not in seen)
        hist[u].append(None if r["timestamp"] is None else _epoch_us(r["timestamp"]))
        seen.add(r["device_id"])
    return out
