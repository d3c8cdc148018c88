"""Registered queries on events, in batch and streamed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import oracle as o
from checks.registry import add, all_of, count_sql, counted
from checks.standins import Inputs, envelopes, snapshots
from viagrid import schemas
from viagrid.operators import ranking
from viagrid.plans import serving
from viagrid.session import work_folder
from viagrid.sources import sinks
from viagrid.streaming import carbon, jobs, payload

col = F.col


ENVELOPE = ["raw_json", "partition_id", "enqueued_time", "sequence_number"]


def event_stream(i: Inputs) -> DataFrame:
    """The events table as a stream of envelopes."""
    schema = i.table("events").schema
    return envelopes(jobs.folder_log(i.spark, f"{i.folder}/events*.parquet", schema))


def in_batches(i: Inputs, label: str, parts: dict[str, str], job: Callable[[DataFrame], None]) -> None:
    """Land the envelopes part by part, in the order given, and run a job after each; ``parts`` are conditions."""
    base = work_folder(i.spark, label)
    for condition in parts.values():
        sinks.append_rows(i.envelopes.filter(condition), base)
        job(jobs.folder_log(i.spark, base))


#: Three batches: the third hours of days, then all but every fifth event of the rest, then those, which come late.
HOUR = "cast(substr(enqueued_time, 12, 2) as int)"
THREE = {"some": f"{HOUR} % 3 = 0", "most": f"{HOUR} % 3 > 0 and sequence_number % 5 > 0", "late": f"{HOUR} % 3 > 0 and sequence_number % 5 = 0"}


def bronze(i: Inputs, base: str) -> str:
    path = f"{base}/bronze"
    jobs.ingest(event_stream(i), path, f"{base}/ingest-progress")
    return path


def ingested(i: Inputs) -> DataFrame:
    """Bronze after two runs of the ingestion: the second finds nothing new."""
    base = work_folder(i.spark, "E1")
    bronze(i, base)
    return i.spark.read.parquet(bronze(i, base)).select(ENVELOPE)


ENVELOPE_SQL = """SELECT kind AS event_type, CAST(user_id % 2 AS VARCHAR) AS partition_id,
 strftime(cycle, '%Y-%m-%d %H:%M:%S') AS enqueued_time, event_id AS sequence_number FROM event_base"""


def with_kind(df: DataFrame) -> DataFrame:
    return df.withColumn("event_type", F.get_json_object("raw_json", "$.event_type")).drop("raw_json")


add("E1_ingest_stream", lambda i: with_kind(ingested(i)), ENVELOPE_SQL)
add(
    "E2_latest_arrival",
    lambda i: with_kind(carbon.latest_arrival(i.spark.read.parquet(bronze(i, work_folder(i.spark, "E2")))).select(ENVELOPE)),
    f"""SELECT * FROM ({ENVELOPE_SQL}) WHERE enqueued_time = (SELECT strftime(MAX(cycle), '%Y-%m-%d %H:%M:%S') FROM event_base)""",
)
add("E3_latest_cycle", lambda i: i.latest_events, all_of("latest_events"))


def routed(i: Inputs, latest_only: bool) -> tuple[str, str]:
    base = work_folder(i.spark, "E4")
    log = jobs.folder_log(i.spark, bronze(i, base))
    jobs.refresh_tables(log, f"{base}/silver", f"{base}/gold", f"{base}/progress", latest_only)
    return f"{base}/silver", f"{base}/gold"


GOLD_SQL = o.EVENT_SQL
add(
    "E4_stream_routes_silver",
    lambda i: counted(i.spark.read.parquet(routed(i, False)[0]), "event_type", "data_timestamp"),
    count_sql("carbon_events", "event_type", "data_timestamp"),
)
add(
    "E4_stream_gold_generation_mix",
    lambda i: i.spark.read.parquet(f"{routed(i, False)[1]}/gold_generation_mix").drop("on_date"),
    o.fuel_mix("carbon_events"),
)
add(
    "E4_stream_gold_latest_national",
    lambda i: i.spark.read.parquet(f"{routed(i, True)[1]}/gold_national_intensity"),
    o.national("latest_events"),
)
for number, (name, rule) in enumerate(GOLD_SQL.items(), start=5):
    add(f"E{number}_{name}", lambda i, n=name: carbon.GOLD[n](i.events), rule("carbon_events"))
    add(f"E{number}_{name}_latest", lambda i, n=name: carbon.GOLD[n](i.latest_events), rule("latest_events"))
add(
    "E9_gold_renewable_summary_with_repeats",
    lambda i: carbon.renewable_summary(i.events, count_repeats=True),
    f"""SELECT period_from, energy_category, {o.units_sum('fuel_percentage', 6)} AS total_percentage FROM (
 SELECT *, {o.ENERGY} AS energy_category FROM carbon_events WHERE event_type = 'generation_mix') GROUP BY ALL""",
)


def three_batches(i: Inputs, table: str) -> DataFrame:
    base = work_folder(i.spark, "E4h")
    in_batches(i, "E4l", THREE, lambda log: jobs.refresh_tables(log, f"{base}/silver", f"{base}/gold", f"{base}/progress", latest_only=False))
    return i.spark.read.parquet(f"{base}/{table}").drop("on_date")


def late_batch(i: Inputs, table: str) -> DataFrame:
    """The newest cycle in two batches, then all that is older."""
    newest = i.envelopes.agg(F.max("enqueued_time")).first()[0]
    parts = {
        "first half": f"enqueued_time = '{newest}' and sequence_number % 2 = 0",
        "second half": f"enqueued_time = '{newest}' and sequence_number % 2 = 1", "older": f"enqueued_time < '{newest}'",
    }
    base = work_folder(i.spark, "E4n")
    in_batches(i, "E4o", parts, lambda log: jobs.refresh_tables(log, f"{base}/silver", f"{base}/gold", f"{base}/progress"))
    return i.spark.read.parquet(f"{base}/{table}")


add(
    "E4_stream_three_batches_silver",
    lambda i: counted(three_batches(i, "silver"), "event_type", "data_timestamp"),
    count_sql("carbon_events", "event_type", "data_timestamp"),
)
for name, rule in GOLD_SQL.items():
    add(f"E4_stream_three_batches_history_{name}", lambda i, n=name: three_batches(i, f"gold/{n}"), rule("carbon_events"))
    add(f"E4_stream_late_batch_latest_{name}", lambda i, n=name: late_batch(i, f"gold/{n}"), rule("latest_events"))


def each_once(i: Inputs) -> str:
    """Bronze of a log in three batches that holds every event twice, some of it very late."""
    base = work_folder(i.spark, "E10o")
    parts = {**THREE, **{f"{name} again": condition for name, condition in THREE.items()}}
    in_batches(i, "E10l", parts, lambda log: jobs.ingest_once(log, f"{base}/bronze", f"{base}/progress"))
    return f"{base}/bronze"



def two_logs(i: Inputs, label: str, job: Callable[[DataFrame, str], None]) -> None:
    """Two logs of half the events each, every arrival day in both, through one job with a checkpoint for each."""
    base = work_folder(i.spark, label)
    for half in ("0", "1"):
        sinks.write_table(i.envelopes.filter(f"sequence_number % 2 = {half}"), f"{base}/log{half}")
        job(jobs.folder_log(i.spark, f"{base}/log{half}"), f"{base}/progress{half}")


def two_streams_ingested(i: Inputs) -> DataFrame:
    """Bronze of two logs, and of one of them again after its checkpoint was lost."""
    base = work_folder(i.spark, "E10c")
    two_logs(i, "E10d", lambda log, progress: jobs.ingest_once(log, f"{base}/bronze", progress))
    jobs.ingest_once(event_stream(i), f"{base}/bronze", f"{base}/renewed-progress")
    return jobs.raw_table(i.spark, f"{base}/bronze").read()


def two_streams_routed(i: Inputs) -> str:
    base = work_folder(i.spark, "E4c")
    two_logs(i, "E4d", lambda log, progress: jobs.refresh_tables(log, f"{base}/silver", f"{base}/gold", progress, latest_only=False))
    return base


def two_streams_timed(i: Inputs) -> DataFrame:
    base = work_folder(i.spark, "E12c")
    two_logs(i, "E12d", lambda log, progress: jobs.keep_timeline(log, f"{base}/timeline", progress))
    return i.spark.read.parquet(f"{base}/timeline").drop("on_date")


def merged_batches(i: Inputs) -> DataFrame:
    """Bronze of twenty batches, merged three at a time on the way."""
    base = work_folder(i.spark, "E1m")
    table = jobs.raw_table(i.spark, f"{base}/bronze")
    for number in range(20):
        table.add(jobs.with_arrival(i.envelopes.filter(f"sequence_number % 20 = {number}")), "log", number)
        table.merge(fan=3)
    table.remove_merged()
    return table.read()


add("E10_stream_new_checkpoint", lambda i: with_kind(two_streams_ingested(i).select(ENVELOPE)), ENVELOPE_SQL)
add(
    "E4_stream_new_checkpoint",
    lambda i: counted(jobs.silver_table(i.spark, f"{two_streams_routed(i)}/silver").read(), "event_type", "data_timestamp"),
    count_sql("carbon_events", "event_type", "data_timestamp"),
)
add(
    "E4_stream_new_checkpoint_gold",
    lambda i: i.spark.read.parquet(f"{two_streams_routed(i)}/gold/gold_regional_intensity").drop("on_date"),
    GOLD_SQL["gold_regional_intensity"]("carbon_events"),
)
add("E1_merged_batches", lambda i: with_kind(merged_batches(i).select(ENVELOPE)), ENVELOPE_SQL)
add("E10_stream_late_event_kept", lambda i: with_kind(i.spark.read.parquet(each_once(i)).select(ENVELOPE)), ENVELOPE_SQL)


def deduplicated(i: Inputs) -> DataFrame:
    """A log that holds every event twice, streamed through the repeat filter.

    The delay is longer than the time the events span, so none can be late.
    """
    base = work_folder(i.spark, "E10")
    log = f"{base}/log"
    sinks.append_rows(i.envelopes, log)
    sinks.append_rows(i.envelopes, log)
    distinct = jobs.without_repeats(jobs.folder_log(i.spark, log), "60 days")
    jobs.ingest(distinct, f"{base}/out", f"{base}/progress")
    return i.spark.read.parquet(f"{base}/out").select(ENVELOPE)


add("E10_stream_without_repeats", lambda i: with_kind(deduplicated(i)), ENVELOPE_SQL)
add(
    "E11_flatten_snapshots",
    lambda i: payload.flatten_snapshots(i.snapshots),
    """WITH s AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, CAST(event_id AS VARCHAR) AS polled FROM events),
 r AS (SELECT *, CAST(unnest(range(1, 2 + user_id % 3)) AS INTEGER) AS region FROM s)
 SELECT 'national_intensity' AS event_type, polled AS "timestamp", 'a' AS "from", 'b' AS "to", value AS forecast,
  value + 1 AS actual, 'low' AS "index", CAST(NULL AS VARCHAR) AS fuel, CAST(NULL AS DOUBLE) AS percentage, CAST(NULL AS INTEGER) AS region_id,
  CAST(NULL AS VARCHAR) AS region_name, CAST(NULL AS VARCHAR) AS dno_region FROM s
 UNION ALL SELECT 'generation_mix', polled, 'a', 'b', NULL, NULL, NULL, 'f' || f, (k + f) / 10.0::DOUBLE, NULL, NULL, NULL
  FROM (SELECT *, unnest(range(0, k % 9 + 1)) AS f FROM s)
 UNION ALL SELECT 'regional_intensity', polled, 'a', 'b', value + region, NULL, 'low', NULL, NULL, region, 'R' || region,
  'D' || region FROM r
 UNION ALL SELECT 'regional_generation', polled, NULL, NULL, NULL, NULL, NULL, 'f' || f, (region + f) / 10.0::DOUBLE, region,
  'R' || region, NULL FROM (SELECT *, unnest(range(0, k % 4 + 1)) AS f FROM r)""",
)
add(
    "E11_snapshots_to_parsed_events",
    lambda i: counted(
        payload.parsed(
            payload.to_json_text(payload.flatten_snapshots(i.snapshots)).withColumn(
                "enqueued_time", F.lit("2024-01-01 00:00:00")
            )
        ),
        "event_type", "fuel_type",
    ),
    """WITH s AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events),
 r AS (SELECT *, unnest(range(1, 2 + user_id % 3)) AS region FROM s)
 SELECT event_type, fuel_type, COUNT(*) AS n FROM (
 SELECT 'national_intensity' AS event_type, NULL AS fuel_type FROM s
 UNION ALL SELECT 'generation_mix', 'f' || f FROM (SELECT unnest(range(0, k % 9 + 1)) AS f FROM s)
 UNION ALL SELECT 'regional_intensity', NULL FROM r
 UNION ALL SELECT 'regional_generation', 'f' || f FROM (SELECT unnest(range(0, k % 4 + 1)) AS f FROM r)) GROUP BY ALL""",
)
TIMELINE_SQL = f"""SELECT data_timestamp AS window_start, COUNT(*) AS readings, {o.mean2('forecast')} AS avg_forecast,
 {o.mean2('actual')} AS avg_actual FROM carbon_events WHERE event_type = 'national_intensity' GROUP BY data_timestamp"""
add("E12_timeline", lambda i: carbon.timeline(i.events), TIMELINE_SQL)


def streamed_timeline(i: Inputs) -> DataFrame:
    base = work_folder(i.spark, "E12")
    jobs.keep_timeline(event_stream(i), f"{base}/timeline", f"{base}/progress")
    return i.spark.read.parquet(f"{base}/timeline").drop("on_date")


def timeline_in_batches(i: Inputs) -> DataFrame:
    """The timeline over the raw table that three late and repeated batches have filled."""
    base = work_folder(i.spark, "E12b")
    raw = each_once(i)
    jobs.keep_timeline(jobs.raw_log(i.spark, raw, files_per_batch=200), f"{base}/timeline", f"{base}/progress")
    return i.spark.read.parquet(f"{base}/timeline").drop("on_date")


add("E12_stream_timeline", streamed_timeline, TIMELINE_SQL)
add("E12_stream_timeline_in_batches", timeline_in_batches, TIMELINE_SQL)
add("E12_stream_new_checkpoint", two_streams_timed, TIMELINE_SQL)
add(
    "E12_category_trend",
    lambda i: carbon.category_trend(i.events),
    f"""SELECT data_timestamp AS window_start, {o.ENERGY} AS energy_category,
 {o.mean2('fuel_percentage', 6)} AS avg_percentage FROM carbon_events WHERE event_type = 'generation_mix' GROUP BY ALL""",
)
add(
    "O2_top_regions_by_forecast",
    lambda i: ranking.top_rows(
        carbon.regional_intensity(i.events).select("period_from", "region_name", "forecast", "intensity_index"),
        5, F.desc("forecast"), "region_name", "period_from",
    ),
    f"""SELECT period_from, region_name, forecast, intensity_index FROM ({o.regional('carbon_events')})
 ORDER BY forecast DESC, region_name, period_from LIMIT 5""",
)
add(
    "O3_fuel_mix_by_share",
    lambda i: carbon.generation_mix(i.events).select("fuel_type", "fuel_percentage", "energy_category")
    .orderBy(F.desc("fuel_percentage")),
    f"SELECT fuel_type, fuel_percentage, energy_category FROM ({o.fuel_mix('carbon_events')}) ORDER BY 2 DESC",
)
add(
    "O5_regional_preview",
    lambda i: carbon.regional_intensity(i.events)
    .select("region_name", "forecast", "intensity_index", "intensity_category")
    .orderBy(F.desc("forecast"), "region_name"),
    f"""SELECT region_name, forecast, intensity_index, intensity_category FROM ({o.regional('carbon_events')})
 ORDER BY forecast DESC, region_name""",
)


def event_views(i: Inputs) -> DataFrame:
    base = work_folder(i.spark, "V9")
    for name, build in carbon.GOLD.items():
        sinks.write_table(build(i.events), f"{base}/{name}")
    return sinks.row_counts(serving.folder_views(i.spark, base, serving.EVENT_VIEWS))


add(
    "V9_event_folder_views", event_views,
    " UNION ALL ".join(
        f"SELECT '{view}' AS view_name, COUNT(*) AS row_count FROM ({GOLD_SQL[folder]('carbon_events')})"
        for view, folder in serving.EVENT_VIEWS.items()
    ),
)
