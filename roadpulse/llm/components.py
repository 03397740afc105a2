"""Connected components of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard

MAX_STEPS = 60


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are attached to the smallest of them and itself:
    the larger neighbours (large star), or the smaller ones and itself (small
    star). Minima are aggregated before the shuffle; no neighbourhood is
    gathered."""
    if large:
        pairs = _both(edges)
    else:
        pairs = edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    least = pairs.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
    joined = pairs.join(least, "x")
    moved = joined.where(F.col("y") > F.col("x")) if large else joined
    out = moved.select(F.col("y").alias("x"), F.col("m").alias("y"))
    if not large:
        out = out.unionByName(least.select("x", F.col("m").alias("y")))
    return out.where(F.col("x") != F.col("y")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Every node hangs on one centre, and no centre on another."""
    torn = edges.groupBy("x").agg(F.min("y").alias("low"), F.max("y").alias("high")).where(F.col("low") != F.col("high"))
    return torn.isEmpty() and edges.join(
        edges.select(F.col("y").alias("x")).distinct(), "x", "left_semi").isEmpty()


def min_labels(links: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of the links (x, y): comp is the smallest
    node reachable. Each step's edges are written to the shared folder, so a
    lost executor costs one step; the number of steps grows with the logarithm
    of the number of nodes. Done when each node hangs on one centre, and no centre on another:
    the stars are then the components, each with one label a node."""
    edges = links.where(F.col("x") != F.col("y")).select("x", "y")
    for _ in range(MAX_STEPS):
        before, edges = edges, cut(_star(_star(edges, large=True), large=False), "components")
        discard(before)
        if _settled(edges):
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    centres = edges.select(F.col("y").alias("node"), F.col("y").alias("comp")).distinct()
    return edges.select(F.col("x").alias("node"), F.col("y").alias("comp")).unionByName(centres)
