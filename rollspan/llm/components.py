"""Connected components by alternating star contractions, in narrow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollspan.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links to one row per linked node: ``node``, ``root``, the smallest node it reaches.

    Each round links every node to the smallest node around it, first from the larger
    side, then from the smaller; the number of rounds grows with the logarithm of the longest chain. A
    node of any degree is reduced by map-side minima, and the joins are plain, so that adaptive execution
    can split a hub. Loops and repeated links don't matter; no links give no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = cut_lineage(e)
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = cut_lineage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = _state(e)
        if now == state:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
