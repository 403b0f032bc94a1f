"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility_lake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    Every round points each node's larger neighbours, then its smaller ones, at the smallest
    node it knows (large star, small star). Paths shrink by half or better, so rounds grow with
    the logarithm of the longest one. Each round is written to the shared folder. A node with many
    links is a group that is only ever aggregated to its minimum, with partial sums on the map side.
    """
    edges = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    size = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while True:
        # Large star: all neighbours of a node that are larger than it meet its smallest.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "links")
        # Small star: a node and its smaller neighbours meet the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "links")
        now = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == size:
            break
        size = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
