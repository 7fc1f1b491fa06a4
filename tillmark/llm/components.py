"""Connected components by alternating large and small stars, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the larger (or smaller or equal) neighbours of each node below its smallest neighbour."""
    pairs = _both_ways(edges) if larger else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = pairs.join(least, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return (
        joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        .union(least.where("a <> low").select("a", F.col("low").alias("b")))
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Nodes of undirected ``edges`` (a, b) with the smallest node reachable: (node, root).

    Neighbours are never gathered: each step is a minimum per node, which is
    summed before the shuffle, and an equi-join that adaptive execution can split.
    Rounds grow with the logarithm of the longest path. Self-loops and nulls
    are ignored; no edges give no rows.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        stars = _stars(_stars(current, True).distinct(), False).distinct()
        current = stored(stars)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
