"""Connected components of a graph too large for one machine, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.plans.durable import durable


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``edges`` (a, b) reaches.

    Large and small stars alternate until nothing changes: every node moves its larger, then its
    smaller neighbours to the smallest one it knows. Each round is a few joins on the node.
    """
    ends = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars, before = durable(ends.distinct()), None
    while True:
        n, mark = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if (n, mark) == before or not n:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = n, mark
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).union(stars.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = durable(moved.union(least.select("a", "m")).distinct())
