"""R3 with the blacklist as a table: codes with validity times instead of a literal list.

``codes``: ``mcc`` and, optionally, ``valid_from`` / ``valid_to``; an interval holds its first instant and
not its last, and a NULL end is open.  The table is brought to one row a code, its overlapping intervals
merged, so a repeated code never multiplies transactions and the lookup is one equi-join and a test
over the code's few disjoint intervals.

A NULL code matches nothing.  A transaction without a time matches only a code that is always valid.
An interval that ends before it begins is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_EXEC, ExecConfig
from .joins import bounded_count

LISTED = "_mcc_listed"


def merged_intervals(codes: DataFrame) -> DataFrame:
    """``__mcc, __valid``: the disjoint validity intervals of each code."""
    ends = [F.col(c) if c in codes.columns else F.lit(None).cast("timestamp_ntz") for c in ("valid_from", "valid_to")]
    rows = codes.select(F.col("mcc").cast("int").alias("__mcc"), ends[0].alias("begin"), ends[1].alias("end"))
    rows = rows.where(F.col("__mcc").isNotNull() & F.coalesce(F.col("begin") < F.col("end"), F.lit(True))).distinct()
    by_begin = Window.partitionBy("__mcc").orderBy(F.col("begin").asc_nulls_first(), F.col("end").asc_nulls_last())
    earlier = by_begin.rowsBetween(Window.unboundedPreceding, -1)
    # a new stretch begins where every earlier interval of the code has ended
    open_before = F.coalesce(F.max(F.col("end").isNull()).over(earlier), F.lit(False))
    gap = F.coalesce(F.col("begin") > F.max("end").over(earlier), F.lit(False)) & ~open_before
    rows = rows.withColumn("stretch", F.sum(gap.cast("long")).over(
        by_begin.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = rows.groupBy("__mcc", "stretch").agg(
        F.when(F.max(F.col("begin").isNull()), F.lit(None)).otherwise(F.min("begin")).alias("begin"),
        F.when(F.max(F.col("end").isNull()), F.lit(None)).otherwise(F.max("end")).alias("end"))
    return stretches.groupBy("__mcc").agg(F.collect_list(F.struct("begin", "end")).alias("__valid"))


def _holds(v: Column, time: Column) -> Column:
    begun = v["begin"].isNull() | F.coalesce(v["begin"] <= time, F.lit(False))
    return begun & (v["end"].isNull() | F.coalesce(time < v["end"], F.lit(False)))


def with_listed(tx: DataFrame, codes: DataFrame, exec_cfg: ExecConfig = DEFAULT_EXEC) -> DataFrame:
    """Add the boolean ``_mcc_listed``: the row's code is on the list at the row's time.

    The list is broadcast after a bounded count of its intervals; above the bound it is a shuffle
    join, where AQE splits a code that many transactions share.
    """
    bound = int(exec_cfg.max_broadcast_dim_rows)
    valid = merged_intervals(codes)
    if bounded_count(codes, bound) <= bound:
        valid = F.broadcast(valid)
    joined = tx.join(valid, tx["merchant_mcc"] == valid["__mcc"], "left")
    listed = F.coalesce(F.exists("__valid", lambda v: _holds(v, F.col("timestamp"))), F.lit(False))
    return joined.withColumn(LISTED, listed).drop("__mcc", "__valid")
