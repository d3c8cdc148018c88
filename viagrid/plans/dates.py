"""Date dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viagrid.functions import calendar

# Fixed value: the year with which the full load's date dimension begins.
FIRST_YEAR = 2000


def spine(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """All days of the years given."""
    years = spark.range(1).select(F.lit(first_year).alias("a"), F.lit(last_year).alias("b"))
    return calendar.date_spine(years, calendar.year_start(F.col("a")), calendar.year_end(F.col("b")))


def spine_of(counts: DataFrame, first_year: int | None = None) -> DataFrame:
    """Days up to the end of the last year counted, from the first one or a given year."""
    first = F.min("year") if first_year is None else F.lit(first_year)
    years = counts.agg(first.alias("a"), F.max("year").alias("b"))
    return calendar.date_spine(years, calendar.year_start(F.col("a")), calendar.year_end(F.col("b")))


def date_dim(days: DataFrame) -> DataFrame:
    """The seven columns used with annual flows."""
    date = F.col("date")
    return days.select(
        "date",
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.quarter(date).alias("quarter"),
        F.date_format(date, "EEEE").alias("day_name"),
        F.date_format(date, "MMMM").alias("month_name"),
        calendar.is_weekend(date).alias("is_weekend"),
    )


def date_dim_fiscal(days: DataFrame) -> DataFrame:
    """The columns used with hourly counts: with day numbers and fiscal periods."""
    date = F.col("date")
    return date_dim(days).withColumns(
        {
            "day": F.dayofmonth(date),
            "day_of_week": F.dayofweek(date),
            "fiscal_year": calendar.fiscal_year(date),
            "fiscal_quarter": calendar.fiscal_quarter(date),
        }
    )
