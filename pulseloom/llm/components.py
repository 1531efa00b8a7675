"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.session import materialise


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "low").alias("low"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; edges go from high to low."""
    low = _lowest(edges)
    moved = edges.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component per node with an edge; a component is named by its smallest node.

    ``edges`` has long columns ``a`` and ``b``. Each round is written to the shared folder, so
    the plan stays short and a lost executor costs one round at most. Rounds grow with the
    logarithm of the longest chain.
    """
    stars = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = materialise(stars, "edges")
    before = _print(stars)
    while True:
        stars = materialise(_small_star(_large_star(stars)), "stars")
        after = _print(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
