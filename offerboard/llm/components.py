"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none that has its own: stars around their smallest node."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("x"))
    nodes = ends.select("x.*").groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.where("up + down > 1").agg(F.count("*")).first()[0]


def _smallest(pairs: DataFrame) -> DataFrame:
    return stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "smallest")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node it reaches.

    Each step joins the edges with every node's smallest neighbour; both are
    written first, so that the join's two inputs are plain shuffles that Spark
    may split at a hot node. The steps end when the edges are stars. All tables
    stay in the shared folder; only a count reaches the driver. Self links and
    repeated edges are allowed.
    """
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    while not _is_forest(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours move to the smallest of the neighbourhood
        near = _smallest(both).select("u", F.least("u", "m").alias("m"))
        e = stored(both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .where("u <> v").distinct(), "large-star")
        # small star: a node and its smaller neighbours move to the smallest of them
        near = _smallest(e)
        moved = e.join(near, "u")
        e = stored(moved.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                  F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                   .select("x.*").where("u <> v").distinct(), "small-star")
    tree = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return tree.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
