"""Ranks and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def dense_rank_within(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Rank by falling value within each group; equal values share a rank."""
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(*by).orderBy(F.desc(value))))


def dense_top(df: DataFrame, value: str, ranks: int, name: str = "rank") -> DataFrame:
    """All rows whose value is among the ``ranks`` highest distinct values.

    Only the distinct values are ranked: Spark takes the top ones per task and
    merges them, so one task sees at most ``ranks`` values per input task, and
    the numbering runs over ``ranks`` rows. Tied rows never meet in one task;
    they stay where they are and look their rank up. ``df`` is read twice: give
    a stored table, or one that is cheap to compute.
    """
    highest = df.select(value).distinct().orderBy(F.desc(value)).limit(ranks)
    ranked = highest.select(
        F.col(value).alias("_value"),
        F.row_number().over(Window.orderBy(F.desc(value))).alias(name),
    )
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in the given order; end it with a key to settle ties."""
    return df.orderBy(*order).limit(n)
