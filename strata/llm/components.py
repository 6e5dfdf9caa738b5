"""Connected components of a graph given as a table of edges, by alternating large-star and
small-star rounds: every round is two aggregations and joins, and long chains shorten fast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of one orderable type); root is the
    least node that the node is linked to. Loops and repeated edges are allowed."""
    edges = materialise(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        # large star: each node's larger neighbours are linked to its least neighbour
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        edges = both.where(F.col("b") > F.col("a")).join(least, "a") \
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # small star: a node's smaller neighbours, and it, are linked to the least of them
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = linked.where(F.col("a") != F.col("b")) \
            .union(least.select("a", F.col("least").alias("b"))).distinct()
        edges = materialise(edges, "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
