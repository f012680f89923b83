"""Connected components by alternating large-star and small-star rounds on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.workspace import materialise


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b); root is the smallest id it reaches.

    Edges, never groups, are what a task holds: the smallest neighbour comes
    from a combined aggregate, and joining it back is a join Spark can split
    where one hub holds most edges. Each round is written to the shared folder.
    """
    star = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges")
    while not _is_stars(star):
        star = materialise(_small_star(_large_star(star)), "edges")
    # Converged: every edge points from a member to its component's smallest id.
    # Stored, so that a join with it is one of two plain shuffles, which Spark can split.
    return materialise(star.select(F.col("u").alias("id"), F.col("v").alias("root"))
                       .unionByName(star.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct(), "roots")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v) is the only one of its u and no v is a u: nothing is left to do, since v < u."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return (ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .filter("up > 1 or up > 0 and down > 0").isEmpty())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
