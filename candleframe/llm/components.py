"""Connected components by alternating star contractions, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.llm.common import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of (u, v) edges with u > v: neighbours move to the smallest of them."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u != v")


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("hub")),
        F.struct(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("hub")))))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("hub").alias("hub")).where("out > 1 OR out * hub > 0").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): every id of an edge with the smallest id of its component.

    Large-star and small-star rounds until every edge leads straight to its root; each round
    is staged. Minima are aggregated before they are joined back, so that a hub's edges are
    never gathered; the number of rounds grows with the logarithm of the longest path.
    """
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    while not _is_star_forest(now):
        now = stage(_stars(_stars(now, large=True), large=False).distinct(), "edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
