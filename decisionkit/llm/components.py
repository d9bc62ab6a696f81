"""Connected components by alternating large-star and small-star, on staged edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Edges point from larger to smaller."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def star_components(edges: DataFrame) -> DataFrame:
    """(u, v) edges of comparable ids -> (u, v) with v the smallest id of u's component, for every u that is not itself it.

    Self loops and repeated edges are harmless, an empty table gives an empty one. Both minima are pre-aggregated per
    task, and no node's neighbours are gathered in one place.
    """
    edges = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _state(edges)
    while seen[0]:
        edges = staged(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    return edges
