"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage


def _least(pairs: DataFrame) -> DataFrame:
    """Smallest ``b`` of each ``a``; partial minima are taken before the shuffle, so a hub costs one row per task."""
    return pairs.groupBy("a").agg(F.min("b").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node of the component.

    Each round links neighbours to the smallest node around (Kiveris et al., "Connected Components in MapReduce and
    Beyond", 2014); the rounds grow with the logarithm of the longest chain. Minima are joined back, so Spark can split
    a hub's rows. Rounds are checkpointed; two sums tell whether anything changed.
    """
    mark = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))]
    now = cut_lineage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, state = None, now.agg(*mark).first()
    while state != before and state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).select("a", F.least("a", "least").alias("least"))
        large = cut_lineage(both.filter("b > a").join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        small = large.join(_least(large), "a")
        now = cut_lineage(small.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
                          .unionByName(small.select("a", F.col("least").alias("b"))).distinct())
        before, state = state, now.agg(*mark).first()
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
