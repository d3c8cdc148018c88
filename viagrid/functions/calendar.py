"""Date spines and date parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FISCAL_START_MONTH = 4


def date_spine(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day between two dates held by each row of ``df``."""
    return df.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))


def year_start(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def fiscal_year(date: Column) -> Column:
    """The year in which the fiscal year of a date began (April)."""
    return F.year(F.add_months(date, 1 - FISCAL_START_MONTH))


def fiscal_quarter(date: Column) -> Column:
    return F.quarter(F.add_months(date, 1 - FISCAL_START_MONTH))


def clock_hour(time_of_day: Column) -> Column:
    """Hour of a text such as ``17:05``; NULL where it is no time of day."""
    hour = F.split_part(F.trim(time_of_day), F.lit(":"), F.lit(1)).try_cast("int")
    valid = F.trim(time_of_day).rlike(r"^\d{1,2}:[0-5]\d(:[0-5]\d)?$") & hour.between(0, 23)
    return F.when(valid, hour)
