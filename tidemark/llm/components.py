"""Connected components of an edge table by alternating star steps; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (itself included)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node (a) and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component: the smallest node reachable) for the nodes of edges (a, b); nodes without an edge to another are absent."""
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "components")
    state = None
    while True:
        now = written(_small_star(_large_star(now)), "components")
        seen = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(seen) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = tuple(seen)
