"""Skew-proof "how many points of my group lie below x" for many probes.

A trailing-window count is a difference of two such prefix counts:
``#{r : lo <= k_r < hi} = below(hi) - below(lo)``.  A per-group window
function computes it with one task per group, which a group holding a third of
all rows turns into a single straggler.  Here the work is split by a global
sort instead:

1. points (weight 1) and probes (weight 0) are unioned and range-partitioned on
   ``(group, key, tag, seq, sign)`` — a total order, so Spark's sampled range
   bounds split even a single hot group (or a single hot timestamp) over many
   partitions;
2. each sorted partition computes running counts per group in one vectorised
   pass (``mapInArrow``: Arrow kernels and numpy, no per-row Python) and
   emits, besides the probe rows, at most two boundary rows: the count of its
   first and of its last group;
3. a group's rows in earlier partitions are exactly the offsets to add; only a
   partition's first group can have any, so the offset table has at most one
   row per partition and is broadcast with that proven bound.

The partition-local pass is materialized (written as Parquet in the session's
``spark.checkpoint.dir``) so the partition ids the offsets refer to are fixed
even if a stage is recomputed after an executor loss.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_LOCAL_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("sign", T.IntegerType()),
    T.StructField("pid", T.IntegerType()),
    T.StructField("cum", T.LongType()),
    T.StructField("head", T.BooleanType()),   # probe in the partition's first group
    T.StructField("kind", T.IntegerType()),   # 0 = probe, 1 = first-group total, 2 = last-group total
    T.StructField("g", T.StringType()),       # group key, boundary rows only
])


def _arrow_schema():
    import pyarrow as pa
    return pa.schema([("seq", pa.int64()), ("sign", pa.int32()), ("pid", pa.int32()), ("cum", pa.int64()),
                      ("head", pa.bool_()), ("kind", pa.int32()), ("g", pa.string())])


_ARROW_SCHEMA = _arrow_schema()


def _running_counts(batches):
    """Per sorted partition: running point count per group at each probe.

    Arrow batches in, Arrow batches out (``mapInArrow``): group boundaries are
    found with Arrow compute kernels on the string key, counts with numpy on
    integer arrays — no per-row Python objects.  Probe rows leave without their
    group key; only the partition's first and last group are reported (with
    their key and count) for the cross-partition offsets.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    carry_key, carry_cnt, have_carry = None, 0, False  # group continuing across batches
    first_key, first_cnt, started = None, None, False  # first group of the partition
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        g = batch.column("g")
        tag = batch.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.empty(n, dtype=bool)
        if n > 1:
            a, b = g.slice(1), g.slice(0, n - 1)
            same = pc.or_kleene(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
            new[1:] = ~same.to_numpy(zero_copy_only=False)
        g0 = g[0].as_py()
        new[0] = not (have_carry and g0 == carry_key)
        cs = np.cumsum(tag)
        gid = np.cumsum(new)
        starts = np.flatnonzero(new)
        base = np.empty(len(starts) + 1, dtype=np.int64)
        base[0] = -carry_cnt                      # rows continuing the carried group
        base[1:] = cs[starts] - tag[starts]
        cum = cs - base[gid]
        if not started:
            first_key, started = g0, True
            later = starts[1:]
        else:
            later = starts
        head = np.zeros(n, dtype=bool)
        if first_cnt is None:                     # the first group is still running
            end = int(later[0]) if len(later) else n
            head[:end] = True
            if len(later):
                first_cnt = int(cum[end - 1]) if end > 0 else int(carry_cnt)
        carry_key, carry_cnt, have_carry = g[n - 1].as_py(), int(cum[-1]), True
        probes = tag == 0
        m = int(probes.sum())
        if m:
            mask = pa.array(probes)
            yield pa.RecordBatch.from_arrays([
                pc.filter(batch.column("seq"), mask).cast(pa.int64()),
                pc.filter(batch.column("sign"), mask).cast(pa.int32()),
                pa.array(np.full(m, pid, dtype=np.int32)),
                pa.array(cum[probes].astype(np.int64)),
                pa.array(head[probes]),
                pa.array(np.zeros(m, dtype=np.int32)),
                pa.nulls(m, pa.string()),
            ], schema=_ARROW_SCHEMA)
    if started:
        rows = ([(first_key, carry_cnt, 1)] if first_cnt is None
                else [(first_key, first_cnt, 1), (carry_key, carry_cnt, 2)])
        k = len(rows)
        yield pa.RecordBatch.from_arrays([
            pa.array([0] * k, type=pa.int64()),
            pa.array([0] * k, type=pa.int32()),
            pa.array([pid] * k, type=pa.int32()),
            pa.array([r[1] for r in rows], type=pa.int64()),
            pa.array([False] * k),
            pa.array([r[2] for r in rows], type=pa.int32()),
            pa.array([r[0] for r in rows], type=pa.string()),
        ], schema=_ARROW_SCHEMA)


def sorted_pass(points: DataFrame, probes: DataFrame, num_partitions: int) -> DataFrame:
    """The partition-local pass of :func:`probe_prefix_counts`: one range exchange, one sort, one Arrow pass."""
    pts = points.select("g", "k", F.lit(1).alias("tag"), F.col("seq").cast("long").alias("seq"),
                        F.lit(0).alias("sign"))
    prb = probes.select("g", "k", F.lit(0).alias("tag"), F.col("seq").cast("long").alias("seq"),
                        F.col("sign").cast("int").alias("sign"))
    order = ["g", "k", "tag", "seq", "sign"]
    srt = pts.unionByName(prb).repartitionByRange(int(num_partitions), *order).sortWithinPartitions(*order)
    # the sort key k stays in the JVM; the pass needs only the group, the weight and the probe id
    return srt.select("g", "tag", "seq", "sign").mapInArrow(_running_counts, _LOCAL_SCHEMA)


def probe_prefix_counts(points: DataFrame, probes: DataFrame, num_partitions: int) -> DataFrame:
    """Count points below each probe, per group.

    ``points``: columns ``g`` (string group, NULL is a group), ``k`` (long), ``seq``.
    ``probes``: columns ``g``, ``k``, ``seq`` (long), ``sign`` (int, non-zero);
    ``(seq, sign)`` must be unique.
    Returns ``(seq, sign, below)`` with ``below = #points p: p.g <=> g and p.k < k``.
    """
    # written, so that the partition ids of rows and of offsets come from one evaluation
    local = materialize(sorted_pass(points, probes, num_partitions), "prefix")
    bounds = local.where(F.col("kind") > 0).select("pid", "g", "kind", F.col("cum").alias("tot"))
    before = Window.partitionBy("g").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    # offset of each partition's first group = its rows in earlier partitions;
    # one row per partition -> the broadcast is bounded by num_partitions
    offsets = (bounds.withColumn("off", F.sum("tot").over(before))
               .where((F.col("kind") == 1) & (F.col("off") > 0))
               .select(F.col("pid").alias("o_pid"), "off"))
    pr = local.where(F.col("kind") == 0)
    joined = pr.join(F.broadcast(offsets), pr["pid"] == offsets["o_pid"], "left")
    off = F.when(F.col("head"), F.coalesce(F.col("off"), F.lit(0))).otherwise(F.lit(0))
    return joined.select("seq", "sign", (F.col("cum") + off).alias("below"))


def sorted_partitions_for(spark, rows_hint: int | None, rows_per_partition: int) -> int:
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows_hint is None:
        return max(base, 1)
    return max(base, -(-int(rows_hint) // max(int(rows_per_partition), 1)), 1)
