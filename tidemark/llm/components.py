"""Connected components of a graph of links, by alternating star contractions over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (a, b long): the smallest node it is connected with.

    A step hangs each node's larger neighbours (large star), then its smaller ones (small star), under its smallest
    neighbour.  Stars are linear in the links, minima are aggregated before the shuffle, and the number of steps grows
    with the logarithm of the longest chain.  It ends when a step changes no link.
    """
    edges = stored(_clean(links.select("a", "b")), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b")
        large = stored(_clean(large), "large-star")
        down = large.select(F.col("b").alias("n"), F.col("a").alias("s"))  # n > s always
        least = stored(down.groupBy("n").agg(F.min("s").alias("m")), "least")
        small = down.join(least, "n").select(F.col("m").alias("a"), F.col("s").alias("b"))
        edges = stored(_clean(small.unionByName(least.select(F.col("m").alias("a"), F.col("n").alias("b")))), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return least_of(edges)
        before = state


def _clean(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def least_of(stars: DataFrame) -> DataFrame:
    leaves = stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
    centres = stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.unionByName(centres)
