"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.session import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    near = _both_ways(edges)
    lowest = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    return near.join(lowest, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    lowest = near.groupBy("u").agg(F.min("v").alias("m"))
    tied = near.join(lowest, "u")
    return tied.select(F.col("m").alias("a"), F.col("v").alias("b")).union(
        lowest.select(F.col("m").alias("a"), F.col("u").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge (a, b); the root is the smallest node reachable.

    Alternating large-star and small-star steps; each round is a written table, so a lost
    executor costs one round. The groupings combine inside the map tasks and the joins are
    plain equi-joins, which Spark splits where a node has very many neighbours.
    """
    edges = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    state = None
    while True:
        found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if found == state or not found["n"]:
            break
        state = found
        starred = _small_star(_large_star(edges)).filter("a <> b").distinct()
        edges = written(starred, "edges")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a"), F.col("a")).distinct()
    )
