"""Connected components of a link table by alternating star contractions.

Every round is a few partial aggregates and equi-joins on the link table; the
links lie in the shared folder between rounds, and only two numbers a round (the
table's row count and checksum) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, label``: the smallest node reachable, for every node with a link (columns ``a, b``)."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = materialize(edges, "links")
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small_low.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        edges = materialize(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the link table did not settle")
    # at rest every node points at its component's smallest node
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
