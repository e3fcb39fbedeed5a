"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _chained(e: DataFrame) -> int:
    """Nodes that keep distinct edges (u, v) from being stars: with two edges to smaller nodes, or with one to a smaller and one to a larger node."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 and up > 0").count()


def components(edges: DataFrame, path: str) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v), which should be cheap to read; the component is its smallest node.

    Each step is a group-by and a join on nodes; steps are written under ``path`` (a shared
    folder), which cuts the lineage. Ends when the edges are stars around the smallest nodes
    (another step would leave them as they are), after a number of steps that grows with the
    logarithm of the longest path.
    """
    spark = edges.sparkSession
    e, step = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v"), 0
    while not step or _chained(e):
        step += 1
        _small(_large(e)).write.parquet(f"{path}/{step}")
        e = spark.read.parquet(f"{path}/{step}")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
