"""Connected components of a graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import discard, staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    inner = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _open_nodes(edges: DataFrame) -> int:
    """Nodes that keep the edges from being stars: below two others, or both below and above some."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("under")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("under")))
    roles = ends.groupBy("node").agg(F.sum("under").alias("under"), F.min("under").alias("least"))
    return roles.where("under > 1 OR (under = 1 AND least = 0)").count()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges`` has columns a and b. Each half of a turn is written out, since the next one reads it
    several times and would repeat its plan; the number of turns grows with the logarithm of the
    longest path. Edges that are stars are done. Only counts come to the driver."""
    edges = staged(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while _open_nodes(edges):
        large = staged(_large_star(edges), "large-stars")
        edges = staged(_small_star(large), "stars")
        discard(large)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
