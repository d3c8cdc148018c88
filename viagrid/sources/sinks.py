"""Writing tables: layouts, provenance columns and reports on what was written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """Provenance of a raw table."""
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_ingestion_date": F.current_date(),
            "_source": F.lit(source),
        }
    )


def with_processed_time(df: DataFrame) -> DataFrame:
    return df.withColumn("_processed_timestamp", F.current_timestamp())


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
    replace_only_present: bool = False, fmt: str = "parquet", sort_by: Sequence[str] = (),
) -> None:
    """Write a table, with its schema replaced on overwrite.

    Without partitions the rows are written where they are. With partitions they
    are rebalanced first: rows of one value go together, so that not every task
    writes to every folder, yet AQE splits a value that holds most rows over
    several tasks. ``replace_only_present`` overwrites just the partitions that
    ``df`` has rows for, so repeating a load leaves the same table. ``sort_by``
    orders each file, without a shuffle, so that filters on those columns skip
    row groups.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_only_present:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Replace an external table that lies in buckets of a key, sorted by it, a file each; returns it.

    Tables in as many buckets of the same key join and group by it without a
    shuffle. Rows of one key share a bucket, so combine those of a key first.
    """
    placed = df.repartition(buckets, key).sortWithinPartitions(key)
    placed.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def write_by_copy(df: DataFrame, path: str, column: str, copy: str | None = None) -> None:
    """Partition by a copy of a column, so that the files keep the column itself."""
    copy = copy or f"{column}_part"
    write_table(df.withColumn(copy, F.col(column)), path, [copy])


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    write_table(df, path, partition_by, mode="append")


def landing_path(base: str, folder: str, at: dt.date) -> str:
    return f"{base.rstrip('/')}/{folder}/{at:%Y/%m/%d}"


def land(df: DataFrame, base: str, folder: str, at: dt.date) -> str:
    """Write snappy Parquet to ``base/folder/yyyy/MM/dd``; returns that path."""
    path = landing_path(base, folder, at)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def written_report(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows, columns and presence of ``year`` for tables read back from storage."""
    reports = []
    for name, path in paths.items():
        stored = spark.read.parquet(path)
        reports.append(
            stored.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(stored.columns)).alias("column_count"),
                F.lit("year" in stored.columns).alias("has_year"),
            )
        )
    return reduce(DataFrame.unionByName, reports)


def row_counts(tables: Mapping[str, DataFrame], label: str = "view_name") -> DataFrame:
    """Rows per table, as one result; no table gives no row."""
    if not tables:
        return SparkSession.active().createDataFrame([], f"{label} string, row_count long")
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
