"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.scratch import stored


def _minima(links: DataFrame) -> DataFrame:
    """Smallest neighbour of each `a`; stored, so that joining it back may split hot nodes."""
    return stored(links.groupBy("a").agg(F.min("b").alias("m")))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    both = _both_ways(links)
    m = F.least("a", "m")
    return both.join(_minima(both), "a").filter("b > a").select(F.col("b").alias("a"), m.alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    smallest = _minima(links)
    others = links.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(smallest.select("a", F.col("m").alias("b")))


def connected_components(links: DataFrame) -> DataFrame:
    """`(node, root)` of every node that has a link; the root is its component's smallest node.

    `links` holds `a` and `b`, both long and never null; direction and repeats do
    not matter. Each round runs on a stored table, so a lost executor costs one
    round at most. Rounds go on until nothing changes; their number grows with
    the logarithm of the longest chain.
    """
    current = stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    digest = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = None
    while True:
        after = current.agg(digest.alias("d")).first()["d"]
        if after == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = after
        current = stored(_small_star(stored(_large_star(current).distinct())).distinct())
