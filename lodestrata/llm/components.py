"""Connected components of a graph in tables, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.session import scratch_path


def _stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _least(edges: DataFrame) -> DataFrame:
    """Per node, the least of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v), where root is the least node it can reach.

    Each step is an aggregate per node and a join on it, so a hub's neighbours are never gathered,
    and its rows can be split. Edges are written after each round; rounds grow with the logarithm
    of the longest path.
    """
    both = lambda e: e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = _stored(spark, edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        around = both(edges)
        large = around.join(_least(around), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        large = _stored(spark, large.where("u <> v"), "edges")
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).union(least.select("u", F.col("least").alias("v")))
        edges = _stored(spark, small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
