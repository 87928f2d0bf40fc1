"""Connected components of a graph too large for one machine, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import stored


def _with_smallest(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the smallest of u and all its partners. Minima are partly formed before the shuffle;
    a node with very many edges is a skewed join key, which Spark splits."""
    smallest = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return edges.join(smallest, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the smallest node reachable, itself included.

    The links shrink to stars in a number of rounds that grows with the logarithm of the longest chain; each round is
    a written table. Links of a node with itself, repeated links and both directions do no harm.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = _with_smallest(down)
        linked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = stored(linked.filter("u <> v").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
