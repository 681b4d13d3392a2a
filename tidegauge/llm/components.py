"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour, itself included."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node, root: every node of edges (u, v) with the smallest node that it reaches.

    Self-links and nulls are left out; repeated edges count once; no edges give
    no rows. The minimum of a hub's neighbours is aggregated before it is
    shuffled and joined back, so no task holds a hub's neighbours. Each round is
    written to the shared folder, and removed after the next one with `scratch`;
    rounds end when the edges stay as they are.
    """
    keep, drop = (scratch.keep, scratch.drop) if scratch else (checkpointed, lambda _: None)
    state = keep(edges.select("u", "v").filter("u <> v").distinct())
    seen = None
    while True:
        earlier = state
        state = keep(_small_star(_large_star(state).distinct()).filter("u <> v").distinct())
        drop(earlier)
        mark = state.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(v as decimal(20, 0)))")).first()
        if mark == seen:
            break
        seen = mark
    stars = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
