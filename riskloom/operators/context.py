"""Per-transaction history context: velocity count and new-device facts.

Two physical strategies compute the same values:

* **per-user windows** (:func:`window_context`): one ``Exchange
  hashpartitioning(user_id)`` feeds every window (the ``(user_id, device_id)``
  windows reuse it), all JVM-side.  A user is one task, so this strategy only
  gets users with at most ``ExecConfig.hot_key_rows`` rows.
* **skew-proof** (:func:`skewproof_context`): velocity counts over overlapping time
  ranges of each user, dense ranges over a range-partitioned global sort
  (:mod:`riskloom.operators.ranges`); device facts as partial aggregates
  (first sightings flagged back by row id; the window dialect's first-seen
  time joined back with hot keys broadcast, :func:`attach_group_aggregates`).
  No task ever holds more than a range, however large one user is.

:func:`with_context` routes hot users to the second strategy and everybody else
to the first.

Dialects (W1-W4 of the design notes):

* window : ``txn_count_window`` = rows of the user whose whole epoch second lies
  in ``[sec - W*60, sec]`` (the current row and its same-second peers count);
  ``first_seen_device`` = earliest timestamp of the (user, device) pair
  (NULL for a NULL timestamp).
* history: ``txn_count_window`` = rows of the user with ``t - W <= t_r < t`` in
  microseconds (0 for a NULL timestamp); ``_new_device`` = the row is the first
  of its (user, device) pair but not the first of the user, ordered by
  ``(timestamp, seq)`` with NULL timestamps last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import ExecConfig, RuleConfig
from ..functions.timecols import LONG_MAX, epoch_micros, floor_seconds, history_micros
from ..session import materialize
from .joins import attach_group_aggregates, join_nullsafe
from .ranges import running_count, with_ranged_counts

USER = "user_id"
DEVICE = "device_id"
TS = "timestamp"
SEQ = "seq"

ROW = "_rid"  # unique id of a materialized hot row; ``seq`` may repeat or be NULL


def with_time_keys(tx: DataFrame, dialect: str) -> DataFrame:
    """Add ``_us`` (µs), ``_key`` (frame key: seconds or µs) and ``_usnl`` (µs, NULL last).

    Window dialect: epoch time (``CAST(ts AS BIGINT)`` semantics).  History
    dialect: the wall clock, like naive datetimes (same thing for NTZ input); the
    instant for times with an offset, like aware ones.
    """
    us = epoch_micros(tx, TS) if dialect == C.DIALECT_WINDOW else history_micros(tx, TS)
    out = tx.withColumn("_us", us)
    key = floor_seconds("_us") if dialect == C.DIALECT_WINDOW else F.col("_us")
    return out.withColumn("_key", key).withColumn("_usnl", F.coalesce(F.col("_us"), F.lit(LONG_MAX)))


# --------------------------------------------------------------------------
# strategy 1: per-user windows
# --------------------------------------------------------------------------

def window_context(tx: DataFrame, rules: RuleConfig, dialect: str) -> DataFrame:
    if dialect == C.DIALECT_WINDOW:
        dev = Window.partitionBy(USER, DEVICE).orderBy(TS)
        # [sec - W*60, sec] = (keys <= sec) - (keys < sec - W*60).  NULL keys sort
        # first and fall in both running counts of a real key, so they cancel;
        # a NULL-key row counts its NULL peers (the first running count).
        upto = running_count([USER], "_key", Window.currentRow)
        before = running_count([USER], "_key", -(rules.window_seconds + 1))
        count = F.when(F.col("_key").isNull(), upto).otherwise(upto - before)
        return (tx.withColumn("first_seen_device", F.min(TS).over(dev))
                  .withColumn("txn_count_window", count))
    by_user = Window.partitionBy(USER).orderBy("_usnl", SEQ)
    by_pair = Window.partitionBy(USER, DEVICE).orderBy("_usnl", SEQ)
    if rules.window_micros > 0:
        # [t - W, t) = (keys < t) - (keys < t - W); NULL times (sorted last) count 0.
        count = F.when(F.col("_us").isNull(), F.lit(0).cast("long")).otherwise(
            running_count([USER], "_usnl", -1) - running_count([USER], "_usnl", -(rules.window_micros + 1)))
    else:
        count = F.lit(0).cast("long")
    return (tx.withColumn("_rn_user", F.row_number().over(by_user))
              .withColumn("txn_count_window", count)
              .withColumn("_rn_pair", F.row_number().over(by_pair))
              .withColumn("_new_device", (F.col("_rn_user") > 1) & (F.col("_rn_pair") == 1))
              .drop("_rn_user", "_rn_pair"))


# --------------------------------------------------------------------------
# strategy 2: skew-proof
# --------------------------------------------------------------------------

def _new_device_ids(rows: DataFrame, exec_cfg: ExecConfig) -> DataFrame:
    """Ids of the rows that show a user's second or later device for the first time (history dialect).

    First rows of pairs and of users, in (time, seq) order, are partial aggregates; the ids wanted are the pairs'
    winners that are not a user's winner.  Written, and broadcast when counted small; else they
    meet the rows on a unique, evenly spread id, so no group ever meets in one task.
    """
    first = F.min(F.struct(F.col("_usnl"), F.col(SEQ), F.col(ROW))).alias("first")
    pairs = materialize(rows.groupBy(USER, DEVICE).agg(first).select(USER, "first"), "first-sightings")
    users = pairs.groupBy(USER).agg(F.min("first").alias("first")).select(F.col(f"first.{ROW}").alias(ROW))
    new = materialize(pairs.select(F.col(f"first.{ROW}").alias(ROW)).join(users, ROW, "left_anti")
                      .withColumn("_new_device", F.lit(True)), "new-devices")
    return F.broadcast(new) if new.count() <= exec_cfg.max_broadcast_keys else new


def skewproof_context(rows: DataFrame, rules: RuleConfig, dialect: str, exec_cfg: ExecConfig) -> DataFrame:
    """``rows`` (materialized, with the row id ``_rid``) and their context columns; the id is dropped."""
    out = with_ranged_counts(rows, rules, dialect, exec_cfg, ROW)
    if dialect == C.DIALECT_WINDOW:
        out = attach_group_aggregates(out, [USER, DEVICE], {"__pair_min": F.min(TS)}, exec_cfg, source=rows)
        # NULL for a row without a time, as in the windows
        out = out.withColumn("first_seen_device", F.when(F.col(TS).isNotNull(), F.col("__pair_min"))).drop("__pair_min")
    else:
        out = out.join(_new_device_ids(rows, exec_cfg), ROW, "left").withColumn(
            "_new_device", F.coalesce(F.col("_new_device"), F.lit(False)))
    return out.drop(ROW)


def _materialized(rows: DataFrame) -> DataFrame:
    """Hot rows written once (Parquet in the checkpoint dir): every aggregate and the windows read it."""
    return materialize(rows.withColumn(ROW, F.monotonically_increasing_id()), "hot-rows")


# --------------------------------------------------------------------------
# router
# --------------------------------------------------------------------------

def with_context(tx: DataFrame, rules: RuleConfig, dialect: str,
                 exec_cfg: ExecConfig = C.DEFAULT_EXEC, key_counts: DataFrame | None = None,
                 rows_upper_bound: int | None = None, split=None) -> DataFrame:
    """Add ``txn_count_window`` and ``first_seen_device`` (window) / ``_new_device`` (history).

    ``key_counts`` (``user_id``, ``_n``) may give rows per user from a cheaper
    source than ``tx`` (e.g. the raw event table before dimension joins) and
    ``rows_upper_bound`` a proven bound on its total (e.g. a footer count):
    when the whole input is within ``hot_key_rows`` no user can be hot and the
    detection job is skipped.  ``split(keys, bounded)`` may give the transactions of
    the hot ``keys`` and those of all other users, taken apart before the dimension
    joins, so that no hot user's rows meet in one task of such a join; without it
    ``tx`` is split.  All three only steer the strategy; the result is the same.
    """
    if dialect not in C.DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}; expected one of {C.DIALECTS}")
    tx = with_time_keys(tx, dialect)
    hot_limit = int(exec_cfg.hot_key_rows)
    if hot_limit <= 0:
        return skewproof_context(_materialized(tx), rules, dialect, exec_cfg)

    if rows_upper_bound is not None:
        if rows_upper_bound <= hot_limit:
            return window_context(tx, rules, dialect)  # no user can exceed the threshold
        partitions = max(int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
        relative = int(exec_cfg.hot_partition_factor * rows_upper_bound / partitions)
        hot_limit = max(hot_limit, min(relative, int(exec_cfg.hot_key_ceiling)))
    # Users above the limit: a partial aggregate, at most rows / hot_limit of them.
    stats = key_counts if key_counts is not None else tx.groupBy(USER).agg(F.count(F.lit(1)).alias("_n"))
    hot = stats.where(F.col("_n") > F.lit(hot_limit))
    n_hot = hot.count()
    if n_hot == 0:
        return window_context(tx, rules, dialect)
    keys = hot.select(USER)
    keys = materialize(keys, "hot-keys")  # read by both the hot and the cold branch
    bounded = n_hot <= exec_cfg.max_broadcast_keys
    if bounded:
        keys = F.broadcast(keys)
    if split is None:
        hot_tx, cold_tx = (join_nullsafe(tx, keys, [USER], how) for how in ("left_semi", "left_anti"))
    else:
        hot_tx, cold_tx = (with_time_keys(part, dialect) for part in split(keys, bounded))
    hot_scored = skewproof_context(_materialized(hot_tx), rules, dialect, exec_cfg)
    return window_context(cold_tx, rules, dialect).unionByName(hot_scored)
