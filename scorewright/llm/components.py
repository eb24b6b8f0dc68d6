"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import forget, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour at most, and none that is one itself has any: each component is a star."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    of_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not of_node.filter("up > 1 or (up > 0 and down > 0)").agg(F.count("*")).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns ``u, v`` (LONG). Returns ``node, component`` for every node with a link;
    the component is its smallest node.

    Each round is a few joins and aggregations on the edges, written as a table in place of the one before; the number of
    rounds grows with the logarithm of the longest chain, and edges that are stars by then take no round more. Nothing is
    gathered on the driver but a count of each round."""
    now = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _settled(now):
        before, now = now, materialize(_small_star(_large_star(now)).distinct())
        forget(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
