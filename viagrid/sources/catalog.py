"""Registering stored tables in the catalog, and reports on the catalog."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viagrid.sources.sinks import row_counts


AUDIT = "schema_name string, table_name string, row_count long, table_type string"


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")


def register(spark: SparkSession, schema: str, paths: Mapping[str, str]) -> None:
    """Point external tables at stored Parquet, replacing earlier entries.

    A partitioned table shows no rows until its partitions are recovered.
    """
    for name, path in paths.items():
        table = f"{schema}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING PARQUET LOCATION '{path}'")
        if any(column.isPartition for column in spark.catalog.listColumns(table)):
            spark.catalog.recoverPartitions(table)


def audit(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of a schema with their row counts and kinds."""
    rows = [
        spark.table(f"{schema}.{entry.name}")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.lit(schema).alias("schema_name"),
            F.lit(entry.name).alias("table_name"),
            "row_count",
            F.lit(entry.tableType).alias("table_type"),
        )
        for entry in spark.catalog.listTables(schema)
        if not entry.isTemporary
    ]
    return reduce(DataFrame.unionByName, rows, spark.createDataFrame([], AUDIT))


def lineage_counts(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """How many rows each layer holds."""
    return row_counts({"bronze": bronze, "silver": silver, "gold": gold}, "layer")


def refresh_statistics(spark: SparkSession, schema: str) -> DataFrame:
    """Analyze every table of a schema; a failure is reported and the rest go on."""
    outcome = []
    for entry in spark.catalog.listTables(schema):
        if entry.isTemporary:
            continue
        try:
            spark.sql(f"ANALYZE TABLE {schema}.{entry.name} COMPUTE STATISTICS FOR ALL COLUMNS")
            outcome.append((entry.name, "updated", None))
        except Exception as error:  # the report carries it
            outcome.append((entry.name, "failed", str(error)))
    return spark.createDataFrame(outcome, "table_name string, status string, message string")


def _partition_rows(spark: SparkSession, table: str, partition: str) -> int | None:
    """Rows of a partition as last analysed; None if it never was."""
    described = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({partition})").filter("col_name = 'Partition Statistics'").first()
    found = re.search(r"(\d+) rows", described["data_type"]) if described else None
    return int(found[1]) if found else None


def refresh_partitions(spark: SparkSession, table: str, column: str, values: Sequence[int | str] = ()) -> tuple[int, int]:
    """Analyze the partitions that a load has written, and those never analysed; returns how many, and the rows of all.

    The other partitions keep their figures and are not read. The table's size
    is taken from its files, its rows are the sum over the partitions. ``table``
    is partitioned by one column.
    """
    known = {row["partition"].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    loaded, analysed, total = {str(value) for value in values}, 0, 0
    for value in loaded - known:  # to recover all partitions would forget what is known of them
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({column}='{value}')")
    for value in sorted(known | loaded):
        partition = f"{column}='{value}'"
        rows = None if value in loaded else _partition_rows(spark, table, partition)
        if rows is None:
            spark.sql(f"ANALYZE TABLE {table} PARTITION ({partition}) COMPUTE STATISTICS")
            analysed, rows = analysed + 1, _partition_rows(spark, table, partition)
        total += rows or 0
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")
    return analysed, total
