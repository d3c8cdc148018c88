"""The registered queries: key, Spark job, and the SQL it must match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import oracle
from checks.standins import Inputs
from viagrid.session import short_methods, work_folder
from viagrid.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BUILDS: dict[str, Callable[[Inputs], DataFrame]] = {}


def add(key: str, build: Callable[[Inputs], DataFrame], body: str | None = None) -> None:
    """Register a job on ``Inputs``; timestamps leave as wall-clock time."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        short_methods(spark)
        df = build(Inputs(spark, folder))
        moments = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in moments})

    if key in QUERIES:
        raise ValueError(f"{key} is registered twice")
    QUERIES[key] = run
    BUILDS[key] = build
    if body is not None:
        ORACLES[key] = oracle.sql(body)


def tally(df: DataFrame, **columns: Column) -> DataFrame:
    """Rows per combination of the given expressions, over the whole table."""
    named = df.select(*(c.alias(name) for name, c in columns.items()))
    return named.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def tally_sql(source: str, **columns: str) -> str:
    listed = ", ".join(f"{c} AS {name}" for name, c in columns.items())
    return f"SELECT *, COUNT(*) AS n FROM (SELECT {listed} FROM {source}) GROUP BY ALL"


def count_sql(source: str, *columns: str) -> str:
    return tally_sql(source, **{name: name for name in columns})


def counted(df: DataFrame, *columns: str) -> DataFrame:
    return tally(df, **{name: F.col(name) for name in columns})


def stored(i: Inputs, label: str, df: DataFrame, partition_by=()) -> str:
    """Write a table to a fresh work folder; returns its path."""
    path = work_folder(i.spark, label)
    sinks.write_table(df, path, partition_by)
    return path


def all_of(name: str) -> str:
    return f"SELECT * FROM {name}"
