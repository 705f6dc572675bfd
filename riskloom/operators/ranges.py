"""Trailing-window counts of very large users, over overlapping time ranges.

A user's times are cut into ranges of equal width, at least one velocity window wide and about
``ExecConfig.range_rows`` rows each.  A row's window then reaches into its own
range and the end of the one before, so every range gets a *halo*: narrow copies (user and time) of the
rows in the last window before its start.  One exchange on (user, range) feeds the same
running-count windows as the per-user path: no user is one task, and nothing is joined back.

Equal widths do not bound a range when times crowd.  Rows per range, halo included, are counted first
(a partial aggregate); ranges beyond four times ``range_rows`` are *dense*, and only their rows are counted by
prefix sums over a global sort (:mod:`riskloom.operators.prefix`), which splits even a single time.

Rows without a time stand in no range: they count 0 (history) or their user's rows without a time (window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import ExecConfig, RuleConfig
from ..session import materialize
from .joins import attach_group_aggregates, join_nullsafe
from .prefix import probe_prefix_counts, sorted_partitions_for

USER = "user_id"
KEY = "_key"
COUNT = "txn_count_window"
RANGE = "__range"
DENSE_FACTOR = 4


def running_count(by: list[str], order_col: str, upper: int) -> Column:
    """Rows of the group with order key <= current + ``upper`` (``upper`` <= 0).

    A frame that starts at UNBOUNDED PRECEDING is evaluated incrementally by
    Spark (one pass per group).  A bounded ``[x PRECEDING, y PRECEDING]`` frame
    would be re-aggregated over its whole buffer for every row — quadratic for
    a dense velocity window — so trailing counts are built as differences of
    two such running counts.
    """
    w = Window.partitionBy(*by).orderBy(order_col).rangeBetween(Window.unboundedPreceding, upper)
    return F.count(F.lit(1)).over(w)


def _reach(rules: RuleConfig, dialect: str) -> int:
    """Length of the window in units of the frame key."""
    return max(rules.window_seconds if dialect == C.DIALECT_WINDOW else rules.window_micros, 0)


def _with_ranges(rows: DataFrame, reach: int, exec_cfg: ExecConfig) -> DataFrame:
    """Add ``__range`` (NULL without a time), ``__next`` (the range whose halo the row is in) and ``__nulls``."""
    facts = {"__n": F.count(KEY), "__lo": F.min(KEY), "__hi": F.max(KEY),
             "__nulls": F.count(F.lit(1)) - F.count(KEY)}
    out = attach_group_aggregates(rows, [USER], facts, exec_cfg)
    size = max(int(exec_cfg.range_rows), 1)
    out = out.withColumn("__wanted", F.expr(f"(__n + {size - 1}) div {size}"))
    # the width: the span over the wanted ranges, rounded up, but never less than the window
    out = out.withColumn("__width", F.when(F.col("__n") > 0, F.greatest(
        F.expr("(__hi - __lo + __wanted) div __wanted"), F.lit(max(reach, 1)).cast("long"))))
    out = out.withColumn(RANGE, F.expr(f"({KEY} - __lo) div __width"))
    start_of_next = F.col("__lo") + (F.col(RANGE) + 1) * F.col("__width")
    out = out.withColumn("__next", F.when((F.col(KEY) >= start_of_next - F.lit(reach)) & (start_of_next <= F.col("__hi")),
                                          F.col(RANGE) + 1))
    return out.drop("__n", "__lo", "__hi", "__wanted", "__width")


def _window_counts(rows: DataFrame, halo: DataFrame, reach: int, dialect: str) -> DataFrame:
    by = [USER, RANGE]
    both = rows.withColumn("__own", F.lit(True)).unionByName(
        halo.withColumn("__own", F.lit(False)), allowMissingColumns=True)
    upper = Window.currentRow if dialect == C.DIALECT_WINDOW else -1       # the row and its peers, or earlier rows only
    count = running_count(by, KEY, upper) - running_count(by, KEY, -(reach + 1))
    return both.withColumn(COUNT, count).where("__own").drop("__own")


def _dense_counts(rows: DataFrame, halo: DataFrame, reach: int, dialect: str, exec_cfg: ExecConfig,
                  row_id: str) -> DataFrame:
    """Counts of the dense ranges' rows by prefix sums: points are rows and halo, probes the rows' window ends."""
    owner = F.when(F.col(USER).isNull(), F.lit("n")).otherwise(F.concat(F.lit("u"), F.col(USER)))
    g = F.concat(F.col(RANGE).cast("string"), owner).alias("g")
    points = rows.select(g, F.col(KEY).alias("k"), F.col(row_id).alias("seq")).unionByName(
        halo.select(g, F.col(KEY).alias("k"), F.lit(0).cast("long").alias("seq")))
    hi = F.col(KEY) + F.lit(1 if dialect == C.DIALECT_WINDOW else 0)
    probes = rows.select(g, hi.alias("k"), F.col(row_id).alias("seq"), F.lit(1).alias("sign")).unionByName(
        rows.select(g, (F.col(KEY) - F.lit(reach)).alias("k"), F.col(row_id).alias("seq"), F.lit(-1).alias("sign")))
    n_parts = sorted_partitions_for(rows.sparkSession, 3 * rows.count(), exec_cfg.sort_rows_per_partition)
    below = probe_prefix_counts(points, probes, n_parts)
    counts = below.groupBy(F.col("seq").alias(row_id)).agg(
        F.sum(F.col("sign") * F.col("below")).cast("long").alias(COUNT))
    return rows.join(counts, row_id, "inner")


def with_ranged_counts(rows: DataFrame, rules: RuleConfig, dialect: str, exec_cfg: ExecConfig,
                       row_id: str) -> DataFrame:
    """Add ``txn_count_window``; ``rows`` have the frame key ``_key`` and a unique ``row_id``."""
    reach = _reach(rules, dialect)
    null_count = F.col("__nulls") if dialect == C.DIALECT_WINDOW else F.lit(0).cast("long")
    ranged = _with_ranges(rows, reach, exec_cfg)
    timeless = ranged.where(F.col(KEY).isNull()).withColumn(COUNT, null_count.cast("long"))
    ranged = ranged.where(F.col(KEY).isNotNull())
    if dialect == C.DIALECT_HISTORY and reach == 0:
        out = ranged.withColumn(COUNT, F.lit(0).cast("long"))               # an empty window
        return out.unionByName(timeless).drop(RANGE, "__next", "__nulls")
    halo = ranged.where(F.col("__next").isNotNull()).select(USER, KEY, F.col("__next").alias(RANGE))
    own = ranged.drop("__next")

    held = own.select(USER, RANGE).unionByName(halo.select(USER, RANGE))
    dense = (held.groupBy(USER, RANGE).agg(F.count(F.lit(1)).alias("__held"))
             .where(F.col("__held") > DENSE_FACTOR * max(int(exec_cfg.range_rows), 1)).select(USER, RANGE))
    dense = materialize(dense, "dense-ranges")          # at most rows / (2 range_rows) of them
    n_dense = dense.count()
    if n_dense == 0:
        out = _window_counts(own, halo, reach, dialect)
    else:
        if n_dense <= exec_cfg.max_broadcast_keys:
            dense = F.broadcast(dense)
        crowded, crowded_halo = (join_nullsafe(f, dense, [USER, RANGE], "left_semi") for f in (own, halo))
        sparse, sparse_halo = (join_nullsafe(f, dense, [USER, RANGE], "left_anti") for f in (own, halo))
        out = _window_counts(sparse, sparse_halo, reach, dialect).unionByName(
            _dense_counts(crowded, crowded_halo, reach, dialect, exec_cfg, row_id))
    return out.unionByName(timeless.drop("__next")).drop(RANGE, "__nulls")
