"""Online scorers on Structured Streaming (T1), both dialects.

The sequential scorer's per-user state machine — score each transaction
against the user's earlier transactions, then remember it — as
``groupBy(user_id).applyInPandasWithState`` with event-time watermarks:

* state per user: the rows that arrived but are not yet final (``pending``),
  the times of released rows still inside the velocity window (``recent``), and
  the devices seen so far with their last sighting (``devices``; unbounded per
  user as in the sequential scorer, or bounded by an opt-in TTL);
* a row is *released* (scored and emitted) once the watermark has passed it,
  so rows that arrive out of order within the watermark delay are still
  scored in ``(timestamp, seq)`` order — the result equals the batch
  history dialect;
* rows behind the watermark are dropped by Spark (reported as
  ``numRowsDroppedByWatermark`` in the query progress);
* an event-time timeout at the earliest pending row releases rows of users
  who send nothing more.

The window dialect (:func:`stream_window_scores`) uses the same machinery, but
a row waits until the watermark has passed the end of its whole second, because
its same-second peers (which may arrive out of order) count too; its state keeps
the released epoch seconds inside the window and each device's first sighting.

Everything after the context columns (points, score, severity, status) is the
same Catalyst projection as in batch (:func:`~riskloom.operators.scoring.apply_rules`).
NULL timestamps cannot be placed in event time and are not accepted here.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from .. import config as C
from ..config import RuleConfig
from ..functions.timecols import epoch_micros, from_epoch_micros
from ..operators.context import with_time_keys
from ..operators.scoring import apply_rules
from ..schema import SCORED_HISTORY_COLUMNS, SCORED_WINDOW_COLUMNS

_ROW_FIELDS = [  # (column, spark type, numpy dtype) carried through the state
    ("txn_id", T.StringType(), object),
    ("amount", T.DoubleType(), np.float64),
    ("currency", T.StringType(), object),
    ("card_country", T.StringType(), object),
    ("ip_country", T.StringType(), object),
    ("merchant_mcc", T.IntegerType(), object),
    ("device_id", T.StringType(), object),
    ("_us", T.LongType(), np.int64),
    ("_ts_us", T.LongType(), np.int64),   # the original value, to rebuild `timestamp` exactly
    ("seq", T.LongType(), np.int64),
]

STATE_SCHEMA = T.StructType(
    [T.StructField(f"p{name}", T.ArrayType(t)) for name, t, _ in _ROW_FIELDS]
    + [T.StructField("recent", T.ArrayType(T.LongType())),
       T.StructField("devices", T.ArrayType(T.StringType())),
       T.StructField("device_last_us", T.ArrayType(T.LongType())),
       T.StructField("seen_any", T.BooleanType())]
)

OUTPUT_SCHEMA = T.StructType([
    T.StructField("txn_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("card_country", T.StringType()),
    T.StructField("ip_country", T.StringType()),
    T.StructField("merchant_mcc", T.IntegerType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("_us", T.LongType()),
    T.StructField("_ts_us", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("txn_count_window", T.LongType()),
    T.StructField("_new_device", T.BooleanType()),
])


def _plain(values, dtype) -> list:
    """Plain Python values for the state (the JVM cannot unpickle numpy scalars)."""
    if dtype is np.int64:
        return [int(v) for v in values]
    if dtype is np.float64:
        return [float(v) for v in values]
    # an integer column with a NULL arrives as float: back to int, or the state's array<int> would lose it
    return [None if v is None or (isinstance(v, float) and v != v)
            else (int(v) if isinstance(v, (np.integer, float)) else v) for v in values]


def _history_state_fn(window_us: int, device_ttl_us: int | None = None):
    names = [n for n, _, _ in _ROW_FIELDS]
    dtypes = {n: d for n, _, d in _ROW_FIELDS}
    k = len(names)

    def step(key, pdfs, state):
        user = key[0]
        if state.exists:
            st = state.get
            pending = pd.DataFrame({n: pd.Series(list(st[i] or []), dtype=dtypes[n]) for i, n in enumerate(names)})
            recent = np.asarray(st[k] or [], dtype=np.int64)
            devices = dict(zip(st[k + 1] or [], st[k + 2] or []))  # device -> last time seen
            seen_any = bool(st[k + 3])
        else:
            pending = pd.DataFrame({n: pd.Series([], dtype=dtypes[n]) for n in names})
            recent, devices, seen_any = np.empty(0, dtype=np.int64), {}, False
        frames = [f for f in [pending] + [p[names] for p in pdfs] if len(f)]
        if frames:
            pending = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        wm_us = int(state.getCurrentWatermarkMs()) * 1000
        us = pending["_us"].to_numpy(dtype=np.int64)
        ready = us <= wm_us
        rel = pending[ready].sort_values(["_us", "seq"], kind="mergesort")
        keep = pending[~ready]
        if len(rel):
            t = rel["_us"].to_numpy(dtype=np.int64)
            times = np.concatenate([recent, t])  # recent <= every released time, both sorted
            counts = np.searchsorted(times, t, "left") - np.searchsorted(times, t - window_us, "left")
            dev_s = rel["device_id"].astype(object).where(rel["device_id"].notna(), None).reset_index(drop=True)
            dev = dev_s.tolist()
            if device_ttl_us is None:
                # vectorised: first sighting in this batch, not seen before, and not the user's first row
                first_here = ~dev_s.duplicated(keep="first").to_numpy()
                known = dev_s.isin(list(devices)).to_numpy() if devices else np.zeros(len(dev), dtype=bool)
                prior = np.ones(len(dev), dtype=bool) if seen_any else np.arange(len(dev)) > 0
                new_device = first_here & ~known & prior
                devices.update(zip(dev, t.tolist()))  # rows are in time order: last sighting wins
                seen_any = True
            else:
                # opt-in TTL: a device unseen for longer than the TTL is forgotten (sequential by nature)
                new_device = np.zeros(len(dev), dtype=bool)
                for i, (d, ti) in enumerate(zip(dev, t.tolist())):
                    last = devices.get(d)
                    if last is not None and ti - last > device_ttl_us:
                        del devices[d]
                    new_device[i] = seen_any and d not in devices
                    devices[d] = ti
                    seen_any = True
            out = rel.copy()
            out.insert(1, "user_id", user)
            out["txn_count_window"] = counts.astype(np.int64)
            out["_new_device"] = new_device
            yield out[[f.name for f in OUTPUT_SCHEMA.fields]]
            recent = times[times >= wm_us - window_us]
        if device_ttl_us is not None:
            devices = {d: last for d, last in devices.items() if wm_us - last <= device_ttl_us}
        state.update(tuple([_plain(keep[n].tolist(), dtypes[n]) for n in names]
                           + [[int(x) for x in recent], list(devices), [int(v) for v in devices.values()],
                              bool(seen_any)]))
        if len(keep):
            state.setTimeoutTimestamp(int(keep["_us"].min()) // 1000 + 1)

    return step


def _window_state_fn(window_seconds: int):
    """Window dialect: a row waits until the watermark has passed the end of its
    whole second (its same-second peers count, and may arrive out of order)."""
    names = [n for n, _, _ in _ROW_FIELDS]
    dtypes = {n: d for n, _, d in _ROW_FIELDS}
    k = len(names)

    def step(key, pdfs, state):
        user = key[0]
        if state.exists:
            st = state.get
            pending = pd.DataFrame({n: pd.Series(list(st[i] or []), dtype=dtypes[n]) for i, n in enumerate(names)})
            recent = np.asarray(st[k] or [], dtype=np.int64)                 # released epoch seconds
            first_seen = dict(zip(st[k + 1] or [], st[k + 2] or []))          # device -> first time (µs)
        else:
            pending = pd.DataFrame({n: pd.Series([], dtype=dtypes[n]) for n in names})
            recent, first_seen = np.empty(0, dtype=np.int64), {}
        frames = [f for f in [pending] + [p[names] for p in pdfs] if len(f)]
        if frames:
            pending = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        wm_us = int(state.getCurrentWatermarkMs()) * 1000
        us = pending["_us"].to_numpy(dtype=np.int64)
        sec = np.floor_divide(us, 1_000_000)
        ready = (sec + 1) * 1_000_000 - 1 <= wm_us          # the whole second is behind the watermark
        rel = pending[ready].sort_values(["_us", "seq"], kind="mergesort")
        keep = pending[~ready]
        if len(rel):
            t = rel["_us"].to_numpy(dtype=np.int64)
            s = np.floor_divide(t, 1_000_000)
            secs = np.concatenate([recent, s])               # recent <= every released second, both sorted
            counts = np.searchsorted(secs, s, "right") - np.searchsorted(secs, s - window_seconds, "left")
            dev_s = rel["device_id"].astype(object).where(rel["device_id"].notna(), None).reset_index(drop=True)
            batch_first = pd.Series(t).groupby(dev_s, sort=False, dropna=False).transform("min").to_numpy()
            known = np.array([first_seen.get(d, np.iinfo(np.int64).max) for d in dev_s.tolist()], dtype=np.int64)
            first = np.minimum(known, batch_first)
            out = rel.copy()
            out.insert(1, "user_id", user)
            out["txn_count_window"] = counts.astype(np.int64)
            out["_first_us"] = first
            yield out[[f.name for f in WINDOW_OUTPUT_SCHEMA.fields]]
            first_seen.update(zip(dev_s.tolist(), first.tolist()))
            recent = secs[secs >= (wm_us // 1_000_000) - window_seconds]
        state.update(tuple([_plain(keep[n].tolist(), dtypes[n]) for n in names]
                           + [[int(x) for x in recent], list(first_seen), [int(v) for v in first_seen.values()]]))
        if len(keep):
            # fire once the watermark passes the end of the earliest pending second
            state.setTimeoutTimestamp(((int(keep["_us"].min()) // 1_000_000) + 1) * 1000 + 1)

    return step


WINDOW_STATE_SCHEMA = T.StructType(
    [T.StructField(f"p{name}", T.ArrayType(t)) for name, t, _ in _ROW_FIELDS]
    + [T.StructField("recent", T.ArrayType(T.LongType())),
       T.StructField("devices", T.ArrayType(T.StringType())),
       T.StructField("device_first_us", T.ArrayType(T.LongType()))]
)

WINDOW_OUTPUT_SCHEMA = T.StructType(
    [f for f in OUTPUT_SCHEMA.fields if f.name != "_new_device"] + [T.StructField("_first_us", T.LongType())]
)


def stream_window_scores(stream_tx: DataFrame, rules: RuleConfig, watermark_delay: str = "0 seconds") -> DataFrame:
    """Streaming window-dialect score table (the batch ``score_window`` columns)."""
    ts_type = stream_tx.schema["timestamp"].dataType
    df = with_time_keys(stream_tx.withColumn("_ts_us", epoch_micros(stream_tx, "timestamp")), C.DIALECT_WINDOW)
    df = df.withColumn("_event_time", F.timestamp_micros("_us")).withWatermark("_event_time", watermark_delay)
    df = df.select("user_id", "_event_time", *[n for n, _, _ in _ROW_FIELDS])
    ctx = df.groupBy("user_id").applyInPandasWithState(
        _window_state_fn(rules.window_seconds), WINDOW_OUTPUT_SCHEMA, WINDOW_STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)
    ctx = (ctx.withColumn("timestamp", from_epoch_micros(F.col("_ts_us"), ts_type))
              .withColumn("first_seen_device", from_epoch_micros(F.col("_first_us"), ts_type)))  # _us == _ts_us here
    return apply_rules(ctx, rules, C.DIALECT_WINDOW).select(*SCORED_WINDOW_COLUMNS)


def stream_context(stream_tx: DataFrame, rules: RuleConfig, watermark_delay: str = "0 seconds",
                   device_ttl_minutes: int | None = None) -> DataFrame:
    """Streaming canonical transactions -> rows with history-dialect context.

    ``device_ttl_minutes`` (off by default, which reproduces the sequential
    scorer) forgets a user's device after that long without a sighting, bounding
    the per-user device set.
    """
    df = with_time_keys(stream_tx.withColumn("_ts_us", epoch_micros(stream_tx, "timestamp")), C.DIALECT_HISTORY)
    df = df.withColumn("_event_time", F.timestamp_micros("_us")).withWatermark("_event_time", watermark_delay)
    # Only the carried columns (and the watermark column) cross into Python.
    df = df.select("user_id", "_event_time", *[n for n, _, _ in _ROW_FIELDS])
    ctx = df.groupBy("user_id").applyInPandasWithState(
        _history_state_fn(rules.window_micros,
                          None if device_ttl_minutes is None else int(device_ttl_minutes) * 60_000_000),
        OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)
    return ctx.withColumn("timestamp", from_epoch_micros(F.col("_ts_us"), stream_tx.schema["timestamp"].dataType))


def stream_scores(stream_tx: DataFrame, rules: RuleConfig, watermark_delay: str = "0 seconds",
                  device_ttl_minutes: int | None = None) -> DataFrame:
    """Streaming history-dialect score table (the batch ``score_history`` columns)."""
    ctx = stream_context(stream_tx, rules, watermark_delay, device_ttl_minutes)
    return apply_rules(ctx, rules, C.DIALECT_HISTORY).select(*SCORED_HISTORY_COLUMNS)
