"""Landed JSON, CSV and Parquet files as DataFrames.

JSON is read one document per line and CSV one record per line, so that Spark
splits large files. Documents over several lines need ``whole_files``, quoted
line breaks ``multi_line``; then each file is one task. A line that is no document
of its contract stops the read, so a document over several lines is not taken for
an empty feed; with ``skip_bad`` it is left out instead, and ``bad_lines`` has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viagrid import schemas

#: Holds the text of a line that is no document of its contract.
BAD = "_bad_line"


def _kept(spark: SparkSession, path: str, schema: str, whole_files: bool) -> DataFrame:
    """All documents, the text of bad ones in ``BAD``."""
    reader = spark.read.schema(f"{schema}, {BAD} string").option("columnNameOfCorruptRecord", BAD)
    return reader.option("mode", "PERMISSIVE").option("multiLine", whole_files).json(path)


def _json(spark: SparkSession, path: str, schema: str, whole_files: bool, skip_bad: bool = False) -> DataFrame:
    if skip_bad:
        return _kept(spark, path, schema, whole_files).filter(F.col(BAD).isNull()).drop(BAD)
    reader = spark.read.schema(schema).option("multiLine", whole_files)
    return (reader if whole_files else reader.option("mode", "FAILFAST")).json(path)


def bad_lines(spark: SparkSession, path: str, schema: str, whole_files: bool = False) -> DataFrame:
    """file, line, and read_as (what could be read of it, as JSON) of every line that is no document of ``schema``.

    With ``whole_files`` a line is a file's whole text.
    """
    documents = _kept(spark, path, schema, whole_files)
    fields = [name for name in documents.columns if name != BAD]
    return documents.filter(F.col(BAD).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(BAD).alias("line"), F.to_json(F.struct(*fields)).alias("read_as")
    )


def line_counts(spark: SparkSession, path: str, schema: str, whole_files: bool = False) -> tuple[int, int]:
    """How many lines there are, and how many of them are bad; a bad one is one whose reading fails anywhere."""
    documents = _kept(spark, path, schema, whole_files)
    fields = [F.col(name) for name in documents.columns if name != BAD]
    # the fields have to be read for their failures to show
    lines, bad, _ = documents.agg(F.count(F.lit(1)), F.count(BAD), F.max(F.hash(*fields))).first()
    return lines, bad


def rows_schema(record: str, field: str = "rows") -> str:
    return f"{field} array<{_struct(record)}>"


def pages_schema(record: str, extra: str = "") -> str:
    fields = ", ".join(part for part in (extra, schemas.PAGE_FIELDS) if part)
    return f"{fields}, data array<{_struct(record)}>"


def read_rows(
    spark: SparkSession, path: str, record: str, field: str = "rows", whole_files: bool = False, skip_bad: bool = False
) -> DataFrame:
    """Records of an envelope ``{field: [...]}``, one envelope per file or line."""
    return _json(spark, path, rows_schema(record, field), whole_files, skip_bad).select(F.inline(field))


def read_pages(
    spark: SparkSession, path: str, record: str, whole_files: bool = False, extra: str = "", skip_bad: bool = False
) -> DataFrame:
    """Page envelopes as they were landed, with ``data`` still nested and the file they lie in as ``_landed``.

    ``extra`` names further envelope fields, for instance the region asked for.
    """
    pages = _json(spark, path, pages_schema(record, extra), whole_files, skip_bad)
    return pages.select("*", F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("_landed"))


def newest_pages(pages: DataFrame, by: list[str]) -> DataFrame:
    """One page per group and page number: of several the one landed last, in one file the one of the larger hash.

    ``by`` names a group; without it all pages belong to one. Pages without a
    number stay. Only pages that were landed more than once are shuffled with
    their records.
    """
    keys = [*by, "current_page"]
    numbered = pages.filter(F.col("current_page").isNotNull())
    repeated = numbered.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").drop("_times")
    marks = repeated.select(*(F.col(key).alias(f"_{key}") for key in keys))
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    match = same[0]
    for condition in same[1:]:
        match = match & condition
    once = pages.join(marks, match, "left_anti")
    others = [name for name in pages.columns if name not in (*keys, "_landed")]
    page = F.struct(*others, "_landed")
    last = numbered.join(marks, match, "left_semi").groupBy(*keys).agg(
        F.max_by(page, F.struct("_landed", F.xxhash64(*others))).alias("_page")
    )
    return once.unionByName(last.select(*keys, "_page.*"))


def page_records(pages: DataFrame) -> DataFrame:
    """All records of all pages; empty pages give none."""
    return pages.select(F.inline("data"))


def page_gaps(pages: DataFrame, by: list[str]) -> DataFrame:
    """Per group that has any: pages read, pages announced, and whether all are there."""
    return pages.groupBy(*by).agg(
        F.count_distinct("current_page").alias("pages_read"),
        F.max("last_page").cast("bigint").alias("pages_announced"),
        F.sum(F.coalesce(F.size("data"), F.lit(0))).alias("records"),
    ).withColumn("complete", F.col("pages_read") == F.col("pages_announced"))


def asked_gaps(pages: DataFrame, by: list[str], asked: DataFrame) -> DataFrame:
    """``page_gaps`` with a row for every group that was asked for: one without any page has read 0 and is not complete."""
    found = page_gaps(pages, by)
    groups = asked.select(*(F.col(name).alias(f"_{name}") for name in by)).distinct()
    match = F.lit(True)
    for name in by:
        match = match & F.col(name).eqNullSafe(F.col(f"_{name}"))
    both = found.join(groups, match, "full_outer")
    return both.select(
        *(F.coalesce(name, f"_{name}").alias(name) for name in by), F.coalesce("pages_read", F.lit(0)).alias("pages_read"),
        "pages_announced", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("complete", F.lit(False)).alias("complete"),
    )


def read_list(spark: SparkSession, path: str, record: str, whole_files: bool = False, skip_bad: bool = False) -> DataFrame:
    """Records of a plain top-level JSON list."""
    return _json(spark, path, record, whole_files, skip_bad)


def read_as_text(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """JSON of mixed types with every primitive read as text; NULL stays NULL.

    Columns are whatever keys occur, so this reads the files once more to list
    them. Give ``schemas.as_text`` of a contract to ``read_list`` to avoid that.
    """
    return (
        spark.read.option("primitivesAsString", True).option("multiLine", whole_files).json(path)
    )


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*(F.col(name).cast("string").alias(name) for name in df.columns))


def read_csv(
    spark: SparkSession, path: str, schema: str, escape: str = '"', multi_line: bool = False
) -> DataFrame:
    """CSV with a header, commas and ``"`` quotes under a fixed schema.

    Columns are matched by position; ``escape`` is ``"`` or a backslash
    depending on the dialect.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", escape)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table; ``fmt="delta"`` works where the cluster has Delta."""
    return spark.read.format(fmt).load(path)


def folder_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A view over all Parquet files below a folder, at any depth."""
    df = spark.read.option("recursiveFileLookup", True).parquet(path)
    df.createOrReplaceTempView(name)
    return df


def _struct(ddl: str) -> str:
    return "struct<" + ", ".join(part.replace(" ", ": ", 1) for part in ddl.split(", ")) + ">"
