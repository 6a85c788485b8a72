"""Connected components of an edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar.session import stash


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node of the neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    kept = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(kept).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edge list ``a, b`` (longs, no nulls).

    ``component`` is the least node that can be reached. Each round is two joins on the node;
    a node with very many links is a skewed join key that Spark splits, the minimum itself is
    combined before the shuffle. Rounds grow with the logarithm of the longest path. Every
    round is written to the shared folder, so a lost executor costs one round at most.
    """
    edges = stash(edges.where("a <> b").distinct(), "edges")
    before = _state(edges)
    while True:
        edges = stash(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
