"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelcast.llm.staging import staged


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """The smallest node reachable from each node of an edge list, as ``node`` and ``component``.

    Both steps point the neighbours of a node at the smallest of them, large-star those above the node and
    small-star those below it. The edge list never grows beyond its first size. It is finished when it is a
    set of stars: no node has two centres, and no centre has one. Minima are combined before the shuffle,
    and a hub's neighbours meet its minimum in a join whose hot partitions Spark can split.
    Null ends and loops are left out; a node that only occurs in those is not in the result.
    """
    current = staged(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull()).where("u <> v").distinct(), "edges")
    while not _only_stars(current):
        current = staged(_small_star(_large_star(current)), "edges")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(current.select("v", "v").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest).distinct()


def _only_stars(edges: DataFrame) -> bool:
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("centres"), F.lit(0).alias("is_centre")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    each = ends.groupBy("node").agg(F.sum("centres").alias("centres"), F.max("is_centre").alias("is_centre"))
    return each.where("centres > 1 or centres = 1 and is_centre = 1").isEmpty()
