"""Joins with descriptive tables.

No join is hinted: Spark broadcasts a side only when its size is known to be
under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges it otherwise, with
AQE splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_region(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """Add ``region_name`` by ``region_id``; unknown regions drop out."""
    names = regions.select(F.col("id").alias("region_id"), F.col("name").alias("region_name"))
    return counts.join(names, "region_id")


def with_authority(counts: DataFrame, authorities: DataFrame) -> DataFrame:
    names = authorities.select(
        F.col("id").alias("local_authority_id"), F.col("name").alias("local_authority_name")
    )
    return counts.join(names, "local_authority_id")


def with_point(facts: DataFrame, count_points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add columns of the count point; the fact's own of the same name give way."""
    own = [name for name in columns if name in facts.columns]
    return facts.drop(*own).join(count_points.select("count_point_id", *columns), "count_point_id")


def in_dates(fact: DataFrame, dates: DataFrame, key: str = "year") -> DataFrame:
    """Filter a fact by a (sliced) date table that has many rows per key.

    A semi-join: the fact's rows are kept or not, never multiplied.
    """
    return fact.join(dates.select(key).distinct(), key, "left_semi")


def missing_from(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Key values of the first table that the second lacks, gaps included."""
    return expected.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")
