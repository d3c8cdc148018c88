"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viagrid.session import work_folder


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to the shared work folder and read back."""
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(least.select("u", F.col("m").alias("v"))).where("u > v")


def _print(edges: DataFrame) -> tuple:
    marks = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), marks).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node reachable.

    ``edges`` has columns u and v; loops, repeats and either direction are
    allowed, nulls are left out. Each round is an aggregate and a join over the
    edges only, written to the work folder, until the edges form stars.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(spark, edges, "edges")
    seen = _print(edges)
    while seen[0]:
        edges = stored(spark, _small_star(_large_star(edges).distinct()).distinct(), "stars")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
