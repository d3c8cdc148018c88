"""Structured Streaming jobs.

Each job drains what is there and stops (``availableNow``); schedule it, or give
another trigger to keep it running. Progress lives in the checkpoint folder, so a
job that is run again, or restarted after a loss, takes up where it stopped.

Tables are kept as :class:`~viagrid.sources.batches.BatchTable`: a batch is known by
the stream's identity, which its checkpoint holds, and its number. Repeated it
counts once; what any other batch has brought stays, however late or early it
came and whichever checkpoint it came from. Small batches are merged as the jobs
go on. No job keeps state, so none forgets or drops an event.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viagrid import schemas
from viagrid.operators.keyed import one_per_key
from viagrid.sources import sinks
from viagrid.sources.batches import FOLDER, BatchTable, Entry
from viagrid.streaming import carbon, payload

DRAIN = {"availableNow": True}
EVENT_KEYS = ("partition_id", "sequence_number")


def kafka_log(spark: SparkSession, servers: str, topic: str, offsets_per_batch: int | None = None) -> DataFrame:
    """Envelopes streamed from a Kafka topic, from its beginning, in batches of a bounded size if one is given."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if offsets_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    return payload.from_kafka(reader.load())


def folder_log(
    spark: SparkSession, path: str, schema: str | T.StructType = schemas.EVENT_ENVELOPE, fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Rows streamed from the files of a folder as they arrive, a bounded number at a time if one is given."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_arrival(envelopes: DataFrame) -> DataFrame:
    """Envelopes with the arrival as TIMESTAMP and as the date by which raw tables are partitioned."""
    at = F.col("enqueued_time").try_cast("timestamp")
    return envelopes.withColumns({"arrived_at": at, "arrival_date": at.cast("date")})


def raw_table(spark: SparkSession, bronze_path: str) -> BatchTable:
    """The raw table of envelopes, by arrival date."""
    return BatchTable(spark, bronze_path, ["arrival_date"])


def raw_log(spark: SparkSession, bronze_path: str, files_per_batch: int | None = None) -> DataFrame:
    """A raw table streamed on, each batch once; folders that merging has made are not read again.

    A batch that broke off and is tried again writes new files, so let this
    stream run when the ingestion is not about to repeat one.
    """
    schema = raw_table(spark, bronze_path).read().schema
    reader = spark.readStream.schema(schema).option("basePath", bronze_path)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{bronze_path}/{FOLDER}=b-*")


def _owner(batch: DataFrame) -> str:
    """The identity of the stream that a batch belongs to; it lies in the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def ingest(log: DataFrame, bronze_path: str, checkpoint: str, trigger: dict = DRAIN) -> None:
    """Append new envelopes to the raw table by arrival date, each exactly once."""

    def act(batch: DataFrame, number: int) -> None:
        table = raw_table(batch.sparkSession, bronze_path)
        table.add(with_arrival(batch), _owner(batch), number)
        table.merge()

    for_each_batch(log, act, checkpoint, trigger=trigger)


def without_repeats(log: DataFrame, delay: str | None) -> DataFrame:
    """Drop events that a producer or an earlier run sent again.

    On a stream, a key is remembered until the watermark has passed it by
    ``delay``, and Spark leaves out rows that come later than that; with None
    every key is remembered for good. ``ingest_once`` needs neither. On stored
    events it is a plain deduplication.
    """
    if not log.isStreaming:
        return one_per_key(log, EVENT_KEYS)
    if delay is None:
        return log.dropDuplicates(list(EVENT_KEYS))
    timed = log.withColumn("_at", F.col("enqueued_time").try_cast("timestamp"))
    return timed.withWatermark("_at", delay).dropDuplicatesWithinWatermark(list(EVENT_KEYS)).drop("_at")


def for_each_batch(
    log: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "append", trigger: dict = DRAIN,
) -> None:
    query = (
        log.writeStream.foreachBatch(act)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(**trigger)
        .start()
    )
    query.awaitTermination()


def _days_of(df: DataFrame, column: str) -> set[str]:
    """The partitions of days that a batch touches."""
    days = (row[0] for row in df.select(column).distinct().collect())
    return {f"{column}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}" for day in days}


def _days_in(parts: list[str]) -> set[str]:
    return {part.split("/")[0] for part in parts}


def ingest_once(log: DataFrame, bronze_path: str, checkpoint: str, trigger: dict = DRAIN) -> None:
    """Append envelopes to the raw table unless it has them already.

    Each batch is held against the stored keys of its own arrival dates: a
    repeated event has the arrival it had before. However late an event comes, it
    is kept once, whichever stream brought it first: where another one has
    added to the table meanwhile, the batch is held against it again.
    """

    def act(batch: DataFrame, number: int) -> None:
        table, owner = raw_table(batch.sparkSession, bronze_path), _owner(batch)
        counted = False
        while not counted:
            now = table.listing()
            if now.holds(owner, number):
                return
            fresh = with_arrival(one_per_key(batch, EVENT_KEYS))
            if now.live:
                stored = table.read(now.live, _days_of(fresh, "arrival_date"))
                seen = stored.select(*(F.col(key).alias(f"_{key}") for key in EVENT_KEYS))
                same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in EVENT_KEYS]
                fresh = fresh.join(seen, same[0] & same[1], "left_anti")
            entry = table.write(fresh, owner, number)
            counted = table.count_in(entry, fresh.schema, owner, number, since=now)
        table.merge()

    for_each_batch(log, act, checkpoint, trigger=trigger)


def _period_day(df: DataFrame) -> Column:
    """The day of an event's period, which all events of a gold key share; the poll's where there is no period."""
    day = F.substring("period_from", 1, 10).try_cast("date")
    if "data_timestamp" not in df.columns:
        return day
    polled = F.col("data_timestamp").cast("date")
    regional = F.col("event_type") == "regional_generation" if "event_type" in df.columns else F.lit(True)
    return F.when(regional, F.coalesce(day, polled)).otherwise(day)


def refresh_tables(
    log: DataFrame, silver_path: str, gold_base: str, checkpoint: str, latest_only: bool = True
) -> None:
    """Silver by day and kind of event from all batches, and the five gold tables.

    Silver keeps every event. With ``latest_only`` gold shows the newest cycle of
    all batches: a batch of an older one leaves it as it is, and a cycle that
    comes in several batches is put together. Otherwise gold holds all history by
    day of the period, and a batch rebuilds the days it has events for.
    """

    def act(batch: DataFrame, number: int) -> None:
        events = sinks.with_processed_time(payload.parsed(batch))
        events = events.withColumn("on_date", _period_day(events))
        silver = silver_table(batch.sparkSession, silver_path)
        entry = silver.add(events, _owner(batch), number)
        if not entry.parts:
            return
        if latest_only:
            _newest_cycle(silver, entry, gold_base)
        else:
            touched = silver.read(parts=_days_in(entry.parts)).drop("on_date")
            for name, build in carbon.GOLD.items():
                table = build(touched)
                by_day = table.withColumn("on_date", _gold_day(name, table))
                sinks.write_table(by_day, f"{gold_base}/{name}", ["on_date"], replace_only_present=True)
        silver.merge()

    for_each_batch(log, act, checkpoint)


def silver_table(spark: SparkSession, silver_path: str) -> BatchTable:
    """Parsed events by day and kind; each folder's last arrival is noted."""
    return BatchTable(spark, silver_path, ["on_date", "event_type"], mark=F.max("event_time"))


def _gold_day(name: str, table: DataFrame) -> Column:
    if name == "gold_regional_generation":
        return _period_day(table)
    return F.substring("period_from", 1, 10).try_cast("date")


def _newest_cycle(silver: BatchTable, entry: Entry, gold_base: str) -> None:
    """Gold of the cycle that arrived last, from the folders that have part of it."""
    live = silver.listing().live
    last = max((e.mark for e in live if e.mark is not None), default=None)
    if last is None or (entry.mark is not None and entry.mark < last):
        return
    rows = silver.read([e for e in live if e.mark == last]).drop("on_date")
    current = carbon.latest_cycle(carbon.latest_by(rows, F.col("event_time")))
    for name, build in carbon.GOLD.items():
        sinks.write_table(build(current), f"{gold_base}/{name}")


def keep_timeline(log: DataFrame, path: str, checkpoint: str, width: str = "30 minutes") -> None:
    """The intensity timeline by day, brought up to date by every batch.

    Each batch adds its sums per window beside the table; the days it touches are
    summed up anew from these. Feed it what ``ingest_once`` has stored: repeated
    events would count again.
    """

    def act(batch: DataFrame, number: int) -> None:
        sums = carbon.timeline_sums(payload.parsed(batch), width=width)
        sums = sums.withColumn("on_date", F.col("window_start").cast("date"))
        parts = BatchTable(batch.sparkSession, f"{path.rstrip('/')}-parts", ["on_date"])
        entry = parts.add(sums, _owner(batch), number)
        if not entry.parts:
            return
        touched = parts.read(parts=_days_in(entry.parts))
        table = carbon.timeline_of(touched).withColumn("on_date", F.col("window_start").cast("date"))
        sinks.write_table(table, path, ["on_date"], replace_only_present=True)
        parts.merge()

    for_each_batch(log, act, checkpoint)
