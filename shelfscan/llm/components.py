"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import cut


def _neighbourhood_min(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u moves to the least node of u's closed
    neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _neighbourhood_min(both).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _neighbourhood_min(down)
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two long columns), where
    root is the component's least node.

    Each round contracts stars with grouped minima (combined before the
    shuffle, so a hub is no hot key there) and joins a table that is unique
    per node (the skewed side can be split).  Rounds are cut by checkpoints
    and end when the edge set no longer changes: O(log^2 n) rounds.  An
    empty edge table gives an empty result; self loops are ignored.
    """
    a, b = edges.columns
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .where("u > v").distinct())
    seen = None
    while True:
        mark = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                     F.sum(F.hash("u", "v").cast("long"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        e = cut(_small_star(_large_star(e)).distinct())
    roots = e.select(F.col("v").alias("node")).distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(roots.select("node", F.col("node").alias("root"))))
