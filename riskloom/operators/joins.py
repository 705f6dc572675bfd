"""Join helpers that keep broadcasts bounded and hot keys split.

* :func:`broadcast_dimension` broadcasts a table only after a (footer) row
  count has proven it small; otherwise the join is left to a shuffle
  (sort-merge, with AQE's skew split).
* :func:`attach_group_aggregates` attaches per-key aggregates to every row of
  the key (an aggregate "joined back") without ever sending a hot key's rows
  to one task: small key tables are broadcast after a bounded count; keys with
  more than ``ExecConfig.hot_key_rows`` rows are joined through a broadcast of
  just the hot keys; the rest through a shuffle join whose groups are bounded
  by the same threshold.  The aggregate itself is a partial (map-side
  combined) ``groupBy``.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_EXEC, ExecConfig
from ..session import materialize


def bounded_count(df: DataFrame, bound: int) -> int:
    """min(count(df), bound + 1) — stops reading once the bound is exceeded."""
    return df.limit(bound + 1).count()


def table_rows(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of table scans, as concurrent Spark jobs.

    For a plain Parquet scan no column is needed, so only file footers are
    read: the proof costs O(files), not O(rows).  The counts are independent
    jobs, submitted from a few driver threads so they run side by side.
    """
    if len(frames) <= 1:
        return {name: df.count() for name, df in frames.items()}
    from pyspark import InheritableThread  # keeps the caller's job group / pool / description

    results: dict[str, int] = {}
    errors: list[BaseException] = []

    def work(name: str, df: DataFrame) -> None:
        try:
            results[name] = df.count()
        except BaseException as e:  # re-raised on the calling thread
            errors.append(e)

    threads = [InheritableThread(target=work, args=(n, d)) for n, d in frames.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return {name: results[name] for name in frames}


def broadcast_dimension(df: DataFrame, max_rows: int, rows: int | None = None) -> DataFrame:
    """Broadcast a dimension *table scan* only when its row count is <= max_rows.

    ``rows`` may carry a count already proven by :func:`table_rows`.
    """
    n = table_rows({"t": df})["t"] if rows is None else rows
    return F.broadcast(df) if n <= max_rows else df


def join_nullsafe(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (keys kept once, from the left)."""
    keys = list(keys)
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__rk_{k}")
    cond: Column | None = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__rk_{k}"])
        cond = c if cond is None else (cond & c)
    out = left.join(renamed, cond, how)
    if how not in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        out = out.drop(*[f"__rk_{k}" for k in keys])
    return out


def attach_group_aggregates(df: DataFrame, keys: list[str], aggs: dict[str, Column],
                            exec_cfg: ExecConfig = DEFAULT_EXEC, source: DataFrame | None = None) -> DataFrame:
    """Add ``aggs`` computed over each ``keys`` group to every row of the group.

    ``source`` may give the same groups from a cheaper frame than ``df``, such as the table it was made of.

    The per-key table is written once: every use of the result reads it, and footers count it.

    1. it has at most ``max_broadcast_keys`` rows: broadcast it — one pass, no
       shuffle of ``df``, no skew;
    2. otherwise, no key above ``hot_key_rows``: shuffle join, every group is
       bounded;
    3. otherwise, hot keys (at most ``rows / hot_key_rows``) are broadcast and
       joined on the hot rows; the cold rows take the shuffle join;
    4. more hot keys than the broadcast bound: shuffle join, AQE splits the
       skewed partitions of the (splittable) left side.
    """
    names = list(aggs)
    rows = df if source is None else source
    stats = materialize(rows.groupBy(*keys).agg(*[aggs[n].alias(n) for n in names], F.count(F.lit(1)).alias("__grp_n")),
                        "group-facts")
    bound = int(exec_cfg.max_broadcast_keys)
    if stats.count() <= bound:
        return join_nullsafe(df, F.broadcast(stats.drop("__grp_n")), keys, "left")
    hot_limit = max(int(exec_cfg.hot_key_rows), 0)
    hot = stats.where(F.col("__grp_n") > F.lit(hot_limit)).drop("__grp_n")
    n_hot = bounded_count(hot, bound)
    if n_hot == 0 or n_hot > bound:
        return join_nullsafe(df, stats.drop("__grp_n"), keys, "left")
    hot_b = F.broadcast(hot.withColumn("__hot", F.lit(True)))
    tagged = join_nullsafe(df, hot_b, keys, "left")
    hot_rows = tagged.where(F.col("__hot").isNotNull()).drop("__hot")
    cold = stats.where(F.col("__grp_n") <= F.lit(hot_limit)).drop("__grp_n")
    cold_rows = join_nullsafe(tagged.where(F.col("__hot").isNull()).drop("__hot", *names), cold, keys, "left")
    return hot_rows.unionByName(cold_rows)
