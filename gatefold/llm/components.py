"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored_copy


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest one (the node included)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of a node, and the node, to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Rounds of large-star and small-star, each stored, until the edges stop changing: the number
    of rounds grows with the logarithm of the longest path. Every round only shuffles edges, and
    minima are taken map-side, so a node with very many links is no bottleneck.
    """
    edges = stored_copy(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(),
        "components",
    )
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if state == seen or state.n == 0:
            break
        seen = state
        edges = stored_copy(_small_star(_large_star(edges)), "components")
    least = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return least.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
