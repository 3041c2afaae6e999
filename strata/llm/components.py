"""Connected components of a link table, by alternating star contraction on shuffled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stage


def _undirected(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = _undirected(links)
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a node, and the node, on the smallest of them.  Links run from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node of its component, itself included.

    Each round is written to shared storage.  Rounds grow with the logarithm
    of the longest path; the only values that reach the driver are a count and
    a sum.  A node with very many links is the many side of a join whose other
    side has one row for it, so adaptive execution may split it.
    """
    state = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = stage(_small_star(_large_star(state)), "star")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = state.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
