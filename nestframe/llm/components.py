"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestframe.operators.durable import durable


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, root`` for the nodes of ``edges (a, b)`` other than roots; the root is a component's smallest node.

    Alternating large and small stars: every node links its larger, then its smaller neighbours to the smallest of
    them, until each node has its root only, which takes about the logarithm of the longest path. A node's neighbours
    are reduced to their minimum before they are shuffled and joined, never collected. Each round is a written table.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for _ in range(rounds):
        edges = durable(edges)
        if _are_stars(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = durable(large)  # here a > b
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = small.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
    raise RuntimeError(f"Components still change after {rounds} rounds")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node of column a has one partner, and is no partner itself."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(None).cast(edges.schema["a"].dataType).alias("to"))
    )
    # A partner has a null among its rows; another node has equal ones.
    seen = ends.groupBy("node").agg(F.min("to").alias("low"), F.max("to").alias("high"), F.count("*").alias("n"), F.count("to").alias("m"))
    return seen.where("low <> high OR m BETWEEN 1 AND n - 1").isEmpty()
