"""Registered queries on scans, sinks, the catalog and incremental loads."""

from __future__ import annotations

import time

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import add, all_of, count_sql, counted, stored, tally, tally_sql
from checks.oracle import EVENT_SQL
from checks.standins import BASE_YEAR, LAST_BASE_YEAR, Inputs, envelopes
from viagrid import schemas
from viagrid.functions import cleaning
from viagrid.operators import lookup
from viagrid.plans import annual, incremental, layout, raw, serving, silver
from viagrid.session import folder_exists, work_folder
from viagrid.sources import catalog, landed, sinks
from viagrid.streaming import carbon, payload

col = F.col
RECORD = "count_point_id int, year int, cars_and_taxis int"
RECORD_SQL = """SELECT CAST(c_custkey AS INTEGER) AS count_point_id, 2000 AS year,
 CAST(floor(c_acctbal) AS INTEGER) AS cars_and_taxis FROM customer"""
PAGE_ROWS = 250


def records(i: Inputs) -> DataFrame:
    return i.table("customer").select(
        col("c_custkey").cast("int").alias("count_point_id"),
        F.lit(2000).alias("year"),
        F.floor("c_acctbal").cast("int").alias("cars_and_taxis"),
    )


def landed_lines(i: Inputs, label: str, lines: DataFrame) -> str:
    path = work_folder(i.spark, label)
    lines.write.text(path)
    return path


def as_json(*columns):
    return F.to_json(F.struct(*columns)).alias("value")


def landed_pages(i: Inputs, lost: int | None = None) -> str:
    """Customers as page envelopes per region, one page per line, at most 250 keys each; ``lost`` is not landed."""
    rows = i.table("customer").select(
        (col("c_nationkey") % 5).cast("int").alias("region"),
        F.expr(f"cast(1 + c_custkey div {PAGE_ROWS} as int)").alias("current_page"),
        F.struct(
            col("c_custkey").cast("int").alias("count_point_id"),
            F.lit(2000).alias("year"),
            F.floor("c_acctbal").cast("int").alias("cars_and_taxis"),
        ).alias("record"),
    )
    grouped = rows.groupBy("region", "current_page").agg(F.collect_list("record").alias("data"))
    ends = rows.groupBy("region").agg(
        F.max("current_page").alias("last_page"), F.count(F.lit(1)).alias("total")
    )
    if lost is not None:
        grouped = grouped.filter(col("current_page") != lost)
    lines = grouped.join(ends, "region").select(
        as_json("region", "current_page", "last_page", "total", F.lit(PAGE_ROWS).alias("per_page"), "data")
    )
    return landed_lines(i, "pages", lines)


def pages(i: Inputs) -> DataFrame:
    return landed.read_pages(i.spark, landed_pages(i), RECORD, extra="region int")


def documents(i: Inputs) -> DataFrame:
    """Arrays of up to 250 records."""
    grouped = records(i).groupBy(F.expr(f"count_point_id div {PAGE_ROWS}").alias("page"))
    return grouped.agg(F.collect_list(F.struct("count_point_id", "year", "cars_and_taxis")).alias("rows"))


def rows_envelope(i: Inputs) -> DataFrame:
    lines = documents(i).select(as_json("rows"))
    return landed.read_rows(i.spark, landed_lines(i, "rows", lines), RECORD)


def plain_list(i: Inputs) -> DataFrame:
    lines = documents(i).select(F.to_json("rows").alias("value"))
    return landed.read_list(i.spark, landed_lines(i, "list", lines), RECORD)


def whole_file(i: Inputs, label: str, lines: DataFrame) -> str:
    """A folder with a file for each document, written over many lines."""
    path = work_folder(i.spark, label)
    spread = lines.withColumn("value", F.regexp_replace("value", r"([{,\[])", "$1\n"))
    spread.write.partitionBy("page").text(path)
    return path


def rows_envelope_whole(i: Inputs) -> DataFrame:
    lines = documents(i).select("page", as_json("rows"))
    return landed.read_rows(i.spark, whole_file(i, "rows", lines), RECORD, whole_files=True)


def plain_list_whole(i: Inputs) -> DataFrame:
    lines = documents(i).select("page", F.to_json("rows").alias("value"))
    return landed.read_list(i.spark, whole_file(i, "list", lines), RECORD, whole_files=True).drop("page")


def mixed_text(i: Inputs) -> DataFrame:
    lines = i.table("customer").select(
        as_json(col("c_custkey").alias("id"), F.when(col("c_custkey") % 2 == 0, col("c_name")).alias("name"))
    )
    return landed.read_as_text(i.spark, landed_lines(i, "text", lines))


def csv_table(i: Inputs, escape: str, multi_line: bool = False) -> DataFrame:
    """Collisions written with quotes and a comma (and a line break) in a column, and read back."""
    path = work_folder(i.spark, "csv")
    awkward = F.concat(F.lit('say "'), col("time"), F.lit('",\nthen' if multi_line else '", then'))
    i.collisions_raw.withColumn("time", awkward).write.option("header", True).option("escape", escape).csv(path)
    return landed.read_csv(i.spark, path, schemas.COLLISIONS, escape=escape, multi_line=multi_line)


CSV_SQL = """SELECT collision_id AS accident_index, date, 'say "' || time || '", then' AS time, latitude, longitude,
 number_of_vehicles, number_of_casualties, speed_limit, accident_severity, urban_or_rural_area, light_conditions,
 weather_conditions FROM collisions_typed"""

add("S1_json_rows_envelope", rows_envelope, RECORD_SQL)
add("S1_json_rows_envelope_whole_files", rows_envelope_whole, RECORD_SQL)
add("S2_json_pages_union", lambda i: landed.page_records(pages(i)), RECORD_SQL)
add(
    "S2_json_pages_complete",
    lambda i: landed.page_gaps(pages(i), ["region"]),
    f"""SELECT region, COUNT(DISTINCT p) AS pages_read, MAX(p) AS pages_announced, COUNT(*) AS records,
 COUNT(DISTINCT p) = MAX(p) AS complete FROM (SELECT CAST(c_nationkey % 5 AS INTEGER) AS region,
 1 + c_custkey // {PAGE_ROWS} AS p FROM customer) GROUP BY region""",
)
add("S3_json_plain_list", plain_list, RECORD_SQL)
add("S3_json_plain_list_whole_files", plain_list_whole, RECORD_SQL)
add(
    "S4_json_all_text", mixed_text,
    "SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name FROM customer",
)
add(
    "S4_cast_all_text",
    lambda i: landed.all_text(i.table("nation")),
    """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
 FROM nation""",
)
add(
    "S4_text_of_doubles_casts_back",
    lambda i: tally(
        landed.all_text(i.table("orders").select((col("o_orderkey") * 12345.0).alias("amount"))),
        amount=cleaning.whole(col("amount")),
    ),
    tally_sql("orders", amount="TRY_CAST(o_orderkey * 12345 AS INTEGER)"),
)
add("S5_csv_doubled_quotes", lambda i: csv_table(i, '"'), CSV_SQL)
add("S6_csv_backslash_escape", lambda i: csv_table(i, "\\"), CSV_SQL)
BROKEN_SQL = CSV_SQL.replace("'\", then'", "'\",' || chr(10) || 'then'")
add("S5_csv_line_breaks", lambda i: csv_table(i, '"', True), BROKEN_SQL)
add("S6_csv_line_breaks", lambda i: csv_table(i, "\\", True), BROKEN_SQL)
add(
    "S7_partitioned_table_scan",
    lambda i: counted(
        landed.read_table(i.spark, stored(i, "S7", i.hourly_counts, ["year"])), "year", "direction_of_travel"
    ),
    count_sql("hourly_counts", "year", "direction_of_travel"),
)
add("S8_parquet_scan", lambda i: landed.read_table(i.spark, f"{i.folder}/orders.parquet"), all_of("orders"))
add(
    "S9_recursive_folder_view",
    lambda i: landed.folder_view(i.spark, "viagrid_s9", _nested(i)).groupBy("collision_id").agg(
        F.max("accident_severity").alias("accident_severity")
    ),
    "SELECT collision_id, accident_severity FROM collisions",
)


def _nested(i: Inputs) -> str:
    """Collisions in two folders below one another."""
    base = work_folder(i.spark, "S9")
    urban = col("is_urban")
    sinks.write_table(i.collisions.filter(urban), f"{base}/a")
    sinks.write_table(i.collisions.filter(~urban), f"{base}/b/c")
    return base


def _registered(i: Inputs, layer: str, tables: dict[str, DataFrame]) -> str:
    """Write tables and register them in a schema of their own."""
    base = work_folder(i.spark, layer)
    schema = f"viagrid_{base.rsplit('-', 1)[1][:12]}"
    catalog.create_schema(i.spark, schema, f"{base}/schema")
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{base}/{name}"
        sinks.write_table(df, paths[name])
    catalog.register(i.spark, schema, paths)
    return schema


add(
    "S10_catalog_table_scan",
    lambda i: i.spark.table(f"{_registered(i, 's10', {'summary': i.summary})}.summary"),
    all_of("fact_traffic_summary"),
)
add(
    "S11_event_log_envelope",
    lambda i: payload.from_kafka(
        envelopes(i.table("events")).select(
            F.encode("raw_json", "utf-8").alias("value"),
            col("partition_id").cast("int").alias("partition"),
            col("enqueued_time").cast("timestamp").alias("timestamp"),
            col("sequence_number").alias("offset"),
        )
    ).select(
        F.get_json_object("raw_json", "$.event_type").alias("event_type"),
        "partition_id", "enqueued_time", "sequence_number",
    ),
    """SELECT kind AS event_type, CAST(user_id % 2 AS VARCHAR) AS partition_id,
 strftime(cycle, '%Y-%m-%d %H:%M:%S') AS enqueued_time, event_id AS sequence_number FROM event_base""",
)
add(
    "S12_date_spine",
    lambda i: i.annual_dates.select("date"),
    "SELECT date FROM annual_days",
)

# ============================================================ sinks
add("K1_overwrite_schema", lambda i: i.spark.read.parquet(_rewritten(i)), all_of("fact_co2_annual"))


def _rewritten(i: Inputs) -> str:
    """A table overwritten by one with other columns."""
    path = stored(i, "K1", i.regions)
    sinks.write_table(i.co2, path)
    return path


add(
    "K2_partition_by_year",
    lambda i: i.spark.read.parquet(stored(i, "K2", i.daily, ["year"])).groupBy("year").agg(
        F.sum("total_all_vehicles").alias("total_all_vehicles"), F.count(F.lit(1)).alias("n")
    ),
    """SELECT year, CAST(SUM(total_all_vehicles) AS BIGINT) AS total_all_vehicles, COUNT(*) AS n FROM daily GROUP BY year""",
)
add(
    "K3_partition_by_collision_year",
    lambda i: i.spark.read.parquet(stored(i, "K3", i.accident_summary, ["collision_year"])),
    all_of("accident_summary"),
)
add(
    "K4_partition_by_event_type",
    lambda i: counted(i.spark.read.parquet(stored(i, "K4", i.events, ["event_type"])), "event_type", "fuel_type"),
    count_sql("carbon_events", "event_type", "fuel_type"),
)


def _by_copy(i: Inputs) -> DataFrame:
    path = work_folder(i.spark, "K5")
    sinks.write_by_copy(i.mix, path, "year")
    return i.spark.read.option("recursiveFileLookup", True).parquet(path)


def _appended(i: Inputs) -> DataFrame:
    path = work_folder(i.spark, "K6")
    urban = col("is_urban")
    sinks.append_rows(i.collisions.filter(urban), path)
    sinks.append_rows(i.collisions.filter(~urban), path)
    return i.spark.read.parquet(path)


add("K5_files_keep_year", _by_copy, all_of("fact_mix_annual"))
add(
    "K6_append",
    lambda i: counted(_appended(i), "collision_year", "severity_label"),
    count_sql("collisions", "collision_year", "severity_label"),
)
add(
    "K7_dated_landing",
    lambda i: i.spark.read.parquet(
        sinks.land(i.authorities, work_folder(i.spark, "K7"), "authorities", dt.date(2024, 1, 31))
    ),
    all_of("authorities"),
)
add(
    "K8_provenance",
    lambda i: tally(
        sinks.with_lineage(i.table("orders"), "orders_feed"),
        feed=col("_source"),
        dated=col("_ingestion_date") == col("_ingestion_timestamp").cast("date"),
    ),
    tally_sql("orders", feed="'orders_feed'", dated="TRUE"),
)
add(
    "K9_processed_time",
    lambda i: tally(
        sinks.with_processed_time(i.regions), id=col("id"), stamped=col("_processed_timestamp").isNotNull()
    ),
    tally_sql("regions", id="id", stamped="TRUE"),
)


def gold(i: Inputs) -> dict[str, DataFrame]:
    """The eight gold tables, of silver counts that are stored first, as a run does."""
    counts = i.spark.read.parquet(stored(i, "gold-counts", i.annual_counts))
    return incremental.gold_tables(
        counts, i.regions, i.authorities, BASE_YEAR, LAST_BASE_YEAR, first_day_year=None
    )


GOLD_SQL = {
    "fact_traffic_summary": "fact_traffic_summary",
    "fact_co2_emissions": "fact_co2_annual",
    "fact_vehicle_mix": "fact_mix_annual",
    "fact_road_analysis": "fact_road",
    "fact_covid_impact": "fact_impact",
    "fact_busiest_roads": "fact_busiest",
    "dim_location": "location",
    "dim_date": "annual_dates",
}


def union_counts(label: str, names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, COUNT(*) AS row_count FROM {source}" for name, source in names.items()
    )


add(
    "K10_K11_register_external",
    lambda i: i.spark.table(f"{_registered(i, 'k11', {'location': i.annual_points})}.location"),
    all_of("annual_points"),
)
add(
    "K11_partitions_recovered",
    lambda i: counted(_partitioned_table(i), "year", "time_period"),
    count_sql("hourly_counts", "year", "time_period"),
)


def _partitioned_table(i: Inputs) -> DataFrame:
    base = work_folder(i.spark, "k11p")
    schema = f"viagrid_{base.rsplit('-', 1)[1][:12]}"
    catalog.create_schema(i.spark, schema, f"{base}/schema")
    sinks.write_table(i.hourly_counts, f"{base}/counts", ["year"])
    catalog.register(i.spark, schema, {"counts": f"{base}/counts"})
    return i.spark.table(f"{schema}.counts")


add(
    "K12_catalog_audit",
    lambda i: catalog.audit(i.spark, _registered(i, "k12", gold(i))).select(
        "table_name", "row_count", "table_type"
    ),
    f"SELECT view_name AS table_name, row_count, 'EXTERNAL' AS table_type FROM ({union_counts('view_name', GOLD_SQL)})",
)
add(
    "K13_layer_counts",
    lambda i: catalog.lineage_counts(i.annual_raw, i.annual_counts, i.summary),
    union_counts(
        "layer", {"bronze": "annual_typed", "silver": "annual_counts", "gold": "fact_traffic_summary"}
    ),
)
add(
    "K14_refresh_statistics",
    lambda i: catalog.refresh_statistics(i.spark, _registered(i, "k14", gold(i))).select(
        "table_name", "status"
    ),
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, 'updated' AS status" for name in GOLD_SQL),
)


def _partition_statistics(i: Inputs) -> DataFrame:
    """A first load analysed whole, then one more year: partitions analysed and rows in all."""
    base = work_folder(i.spark, "k14p")
    schema = f"viagrid_{base.rsplit('-', 1)[1][:12]}"
    early = i.annual_counts.filter("year <> 1999")
    sinks.write_table(early, f"{base}/counts", ["year"])
    catalog.create_schema(i.spark, schema, base)
    catalog.register(i.spark, schema, {"counts": f"{base}/counts"})
    runs = [catalog.refresh_partitions(i.spark, f"{schema}.counts", "year")]
    sinks.write_table(i.annual_counts.filter("year = 1999"), f"{base}/counts", ["year"], replace_only_present=True)
    runs.append(catalog.refresh_partitions(i.spark, f"{schema}.counts", "year", [1999]))
    return i.spark.createDataFrame([(n, *found) for n, found in enumerate(runs, 1)], "run int, analysed long, total long")


add(
    "K14_loaded_partitions_only", _partition_statistics,
    """SELECT 1 AS run, COUNT(DISTINCT year) AS analysed, COUNT(*) AS total FROM annual_counts WHERE year <> 1999
 UNION ALL SELECT 2, 1, COUNT(*) FROM annual_counts""",
)


def _written(i: Inputs) -> DataFrame:
    tables = {"counts": i.annual_counts, "co2": i.co2, "regions": i.regions}
    return sinks.written_report(i.spark, {name: stored(i, "K15", df) for name, df in tables.items()})


add(
    "K15_written_report", _written,
    """SELECT 'counts' AS table_name, COUNT(*) AS row_count, 19 AS column_count, TRUE AS has_year FROM annual_counts
 UNION ALL SELECT 'co2', COUNT(*), 8, TRUE FROM fact_co2_annual UNION ALL SELECT 'regions', COUNT(*), 2, FALSE FROM regions""",
)
add(
    "U1_view_row_counts",
    lambda i: sinks.row_counts(gold(i)),
    union_counts("view_name", GOLD_SQL),
)

# ============================================================ pass-through views


def _batch_views(i: Inputs) -> DataFrame:
    base = work_folder(i.spark, "V8")
    for name, df in gold(i).items():
        sinks.write_table(df, f"{base}/{name}")
    return sinks.row_counts(serving.folder_views(i.spark, base, serving.BATCH_VIEWS))


add(
    "V8_batch_folder_views", _batch_views,
    union_counts("view_name", {v: GOLD_SQL[f] for v, f in serving.BATCH_VIEWS.items()}),
)

# ============================================================ incremental loads


def typed_source(i: Inputs) -> DataFrame:
    return i.annual_raw


def _early(i: Inputs) -> DataFrame:
    """What was loaded at first: the years up to 1998, less 1996."""
    year = col("year").try_cast("int")
    return typed_source(i).filter((year <= 1998) & (year != 1996))


def _early_gold(i: Inputs) -> DataFrame:
    return annual.traffic_summary(silver.annual_counts(_early(i)), i.regions)


def _loaded_twice(i: Inputs) -> DataFrame:
    """The first years, then the missing ones, and the latter once more."""
    path = f"{work_folder(i.spark, 'I3')}/counts"
    incremental.load_missing(_early(i), None, path)
    seen = i.spark.createDataFrame([(1995,), (1997,), (1998,)], "year int")
    incremental.load_missing(typed_source(i), seen, path)
    incremental.load_missing(typed_source(i), seen, path)
    return incremental.read_loaded(i.spark, path)


def _reference(i: Inputs) -> dict[str, DataFrame]:
    return {
        "regions": i.regions_raw, "local_authorities": i.authorities_raw, "count_points": i.annual_points_raw
    }


def _incremental_run(i: Inputs, table: str) -> DataFrame:
    base = work_folder(i.spark, "I5")
    options = {"base_year": BASE_YEAR, "last_year": LAST_BASE_YEAR, "first_day_year": None}
    incremental.run(i.spark, _early(i), _reference(i), base, **options)
    incremental.run(i.spark, typed_source(i), _reference(i), base, **options)
    return incremental.gold_table(i.spark, base, table)


def _resumed(i: Inputs) -> DataFrame:
    """A first run, one that breaks off within gold, and its repetition; then the rows of all eight tables."""
    base = work_folder(i.spark, "I2r")
    options = {"base_year": BASE_YEAR, "last_year": LAST_BASE_YEAR, "first_day_year": None}
    incremental.run(i.spark, _early(i), _reference(i), base, **options)
    whole = annual.mix_from

    def broken(*_):
        raise RuntimeError("lost")

    annual.mix_from = broken
    try:
        incremental.run(i.spark, typed_source(i), _reference(i), base, **options)
        outcome = "not broken"
    except RuntimeError:
        annual.mix_from = whole
        outcome = incremental.run(i.spark, typed_source(i), _reference(i), base, **options)
    finally:
        annual.mix_from = whole
    tables = {name: incremental.gold_table(i.spark, base, name) for name in GOLD_SQL}
    return sinks.row_counts(tables).withColumn("outcome", F.lit(outcome))


def _renamed_after_failure(i: Inputs, table: str) -> DataFrame:
    """Loaded under other region names; the run that renames them breaks off after the first yearly table."""
    base = work_folder(i.spark, "I5n")
    options = {"base_year": BASE_YEAR, "last_year": LAST_BASE_YEAR, "first_day_year": None}
    other = {**_reference(i), "regions": i.regions_raw.withColumn("name", F.concat(F.lit("former "), "name"))}
    incremental.run(i.spark, _early(i), other, base, **options)
    whole = annual.impact_from

    def broken(*_):
        raise RuntimeError("lost")

    annual.impact_from = broken
    try:
        incremental.run(i.spark, typed_source(i), _reference(i), base, **options)
    except RuntimeError:
        pass
    finally:
        annual.impact_from = whole
    incremental.run(i.spark, typed_source(i), _reference(i), base, **options)
    return incremental.gold_table(i.spark, base, table)


def _corrected_year(i: Inputs) -> DataFrame:
    """A year whose counts were wrong when it was loaded, found again by its fingerprint."""
    base = work_folder(i.spark, "I5c")
    options = {"base_year": BASE_YEAR, "last_year": LAST_BASE_YEAR, "first_day_year": None}
    wrong = typed_source(i).withColumn("lgvs", F.when(col("year") == "1997", "7").otherwise(col("lgvs")))
    incremental.run(i.spark, wrong, _reference(i), base, **options)
    incremental.run(i.spark, typed_source(i), _reference(i), base, recheck=True, **options)
    return incremental.gold_table(i.spark, base, "fact_traffic_summary")


def _unusable_years(i: Inputs) -> DataFrame:
    """A year of which no row passes silver is loaded once, not with every run."""
    base = work_folder(i.spark, "I2u")
    source = typed_source(i).withColumn("latitude", F.when(col("year") == "1997", "0").otherwise(col("latitude")))
    runs = [incremental.run(i.spark, source, _reference(i), base, first_day_year=None) for _ in range(2)]
    counts = i.spark.read.parquet(f"{base}/silver/counts").groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("runs", F.lit(", ".join(runs)))


def _repeat_run(i: Inputs) -> DataFrame:
    """Outcome of a first run and of one that finds nothing new, with the rows stored."""
    base = work_folder(i.spark, "I2")
    first = incremental.run(i.spark, typed_source(i), _reference(i), base, first_day_year=None)
    second = incremental.run(i.spark, typed_source(i), _reference(i), base, first_day_year=None)
    return i.spark.read.parquet(f"{base}/silver/counts").agg(
        F.lit(first).alias("first_run"), F.lit(second).alias("second_run"), F.count(F.lit(1)).alias("n")
    )


add(
    "I1_high_water_mark",
    lambda i: incremental.high_water_mark(i.summary, i.spark),
    "SELECT MAX(year) AS latest_year FROM fact_traffic_summary",
)
add(
    "I2_no_new_data", _repeat_run,
    "SELECT 'LOADED' AS first_run, 'NO_NEW_DATA' AS second_run, COUNT(*) AS n FROM annual_counts",
)
add(
    "I2_resumed_after_failure", _resumed,
    f"SELECT *, 'LOADED' AS outcome FROM ({union_counts('view_name', GOLD_SQL)})",
)
add(
    "I2_year_without_valid_rows", _unusable_years,
    "SELECT year, COUNT(*) AS n, 'LOADED, NO_NEW_DATA' AS runs FROM annual_counts WHERE year <> 1997 GROUP BY year",
)
add(
    "I3_append_missing_years",
    lambda i: counted(_loaded_twice(i), "year", "region_id"),
    tally_sql(
        "annual_typed WHERE year IS NOT NULL", year="CAST(year AS VARCHAR)", region_id="CAST(region_id AS VARCHAR)"
    ),
)


def _refreshed(i: Inputs) -> DataFrame:
    base = work_folder(i.spark, "I4")
    incremental.refresh_reference(_reference(i), base)
    incremental.refresh_reference(_reference(i), base)
    return silver.named_areas(i.spark.read.parquet(f"{base}/local_authorities"))


add("I4_reference_refresh", _refreshed, all_of("authorities"))
add("I5_rebuilt_summary", lambda i: _incremental_run(i, "fact_traffic_summary"), all_of("fact_traffic_summary"))
add("I5_rebuilt_vehicle_mix", lambda i: _incremental_run(i, "fact_vehicle_mix"), all_of("fact_mix_annual"))
add("I5_rebuilt_road_analysis", lambda i: _incremental_run(i, "fact_road_analysis"), all_of("fact_road"))
add("I5_rebuilt_busiest_roads", lambda i: _incremental_run(i, "fact_busiest_roads"), all_of("fact_busiest"))
add("I5_renamed_region_after_failure", lambda i: _renamed_after_failure(i, "fact_traffic_summary"), all_of("fact_traffic_summary"))
add("I5_renamed_region_after_failure_roads", lambda i: _renamed_after_failure(i, "fact_road_analysis"), all_of("fact_road"))
add("I5_corrected_year", _corrected_year, all_of("fact_traffic_summary"))
add("I5_rebuilt_location", lambda i: _incremental_run(i, "dim_location"), all_of("location"))
MISSING_SQL = """SELECT DISTINCT year FROM annual_typed WHERE year IS NOT NULL AND year NOT IN (1995, 1997, 1998)"""
add(
    "J11_missing_years",
    lambda i: incremental.missing_years(typed_source(i), _early_gold(i)),
    MISSING_SQL,
)
add(
    "U4_year_difference",
    lambda i: lookup.missing_from(i.annual_counts, _early_gold(i), "year"),
    """SELECT DISTINCT year FROM annual_counts WHERE year NOT IN (1995, 1997, 1998)""",
)


# ============================================================ raw layer and whole catalogue


def _feeds(i: Inputs, lost: int | None = None) -> dict[str, raw.Feed]:
    """Pages by region (without page ``lost``), a list of text, and a CSV feed."""
    nation = i.table("nation").select(as_json(col("n_nationkey").alias("id"), col("n_name").alias("name")))
    csv = work_folder(i.spark, "feed-csv")
    i.collisions_raw.write.option("header", True).csv(csv)
    return {
        "counts": raw.Feed(landed_pages(i, lost), RECORD, "pages", by="region int"),
        "authorities": raw.Feed(landed_lines(i, "feed-list", nation), "id int, name string", text=True),
        "collisions": raw.Feed(csv, schemas.COLLISIONS, "csv"),
    }


def _page_landed_twice(i: Inputs) -> DataFrame:
    """The feed, and before it an older state of every second page, in the same folder."""
    path = landed_pages(i)
    lines = i.spark.read.text(path)
    page = F.get_json_object("value", "$.current_page").cast("int")
    older = lines.filter(page % 2 == 0).select(F.regexp_replace("value", '"year":2000', '"year":1999').alias("value"))
    both = work_folder(i.spark, "pages-twice")
    for part in (older, lines, lines.filter(page == 1)):  # the first pages once more, unchanged
        part.write.mode("append").text(both)
        time.sleep(1.1)  # the later file counts
    return raw.Feed(both, RECORD, "pages", by="region int").read(i.spark)


def _group_missing(i: Inputs) -> DataFrame:
    """A feed that was asked for by all nations of a region or more, of which one has no pages."""
    base = work_folder(i.spark, "raw-group")
    feed = raw.Feed(landed_pages(i), RECORD, "pages", by="region int", asked=i.spark.range(6).select(col("id").cast("int").alias("region")))
    try:
        raw.run(i.spark, {"counts": feed}, base)
        outcome = "written"
    except raw.IncompleteFeed:
        outcome = "refused" if not folder_exists(i.spark, base) else "refused too late"
    return feed.gaps(i.spark).select("region", "pages_read", "records").withColumn("outcome", F.lit(outcome))


def _bad_lines(i: Inputs) -> DataFrame:
    """A list feed in which every 500th line is cut off and every 700th has text for a number."""
    path = work_folder(i.spark, "spoilt")
    line = F.to_json(F.struct(col("c_custkey").alias("id"), col("c_name").alias("name")))
    key = col("c_custkey")
    spoilt = F.when(key % 500 == 0, F.substring(line, 1, 9)).when(key % 700 == 0, F.lit('{"id":"none"}')).otherwise(line)
    i.table("customer").select(spoilt.alias("value")).write.text(path)
    feed = raw.Feed(path, "id int, name string", bad_share=0.01)
    return raw.run(i.spark, {"names": feed}, work_folder(i.spark, "raw-spoilt")).select("table_name", "row_count")


def _raw_run(i: Inputs) -> DataFrame:
    base = work_folder(i.spark, "raw")
    report = raw.run(i.spark, _feeds(i), base)
    sources = [i.spark.read.parquet(f"{base}/{name}").select("_source").distinct() for name in ("counts", "authorities", "collisions")]
    named = sources[0].union(sources[1]).union(sources[2])
    return report.join(named, report["table_name"] == named["_source"], "left")


def _refused(i: Inputs) -> DataFrame:
    """A feed without its second pages: how it is refused, and what is written."""
    base = work_folder(i.spark, "raw-refused")
    try:
        raw.run(i.spark, _feeds(i, lost=2), base)
        outcome = "written"
    except raw.IncompleteFeed:
        outcome = "refused" if not folder_exists(i.spark, base) else "refused too late"
    return i.table("customer").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", F.lit(outcome))


add(
    "B_run_raw_layer", _raw_run,
    """SELECT 'counts' AS table_name, COUNT(*) AS row_count, 6 AS column_count, TRUE AS has_year, 'counts' AS _source FROM customer
 UNION ALL SELECT 'authorities', COUNT(*), 5, FALSE, 'authorities' FROM nation
 UNION ALL SELECT 'collisions', COUNT(*), 15, FALSE, 'collisions' FROM orders""",
)
add("S2_page_landed_twice", _page_landed_twice, RECORD_SQL)
add("B_run_refuses_missing_group", _group_missing, "SELECT CAST(5 AS INTEGER) AS region, 0::BIGINT AS pages_read, 0::BIGINT AS records, 'refused' AS outcome")
add(
    "B_run_bad_lines", _bad_lines,
    """WITH s AS (SELECT c_custkey % 500 = 0 OR c_custkey % 700 = 0 AS bad FROM customer)
 SELECT 'names' AS table_name, COUNT(*) FILTER (NOT bad) AS row_count FROM s
 UNION ALL SELECT 'names_bad_lines', COUNT(*) FILTER (bad) FROM s HAVING COUNT(*) FILTER (bad) > 0""",
)
add("B_run_refuses_missing_pages", _refused, f"SELECT COUNT(*) AS n, CASE WHEN COUNT(*) > {PAGE_ROWS} THEN 'refused' ELSE 'written' END AS outcome FROM customer")


def _whole_catalogue(i: Inputs) -> DataFrame:
    """All layers of a run and the event tables, registered by name and audited."""
    base = work_folder(i.spark, "catalogue")
    options = {"base_year": BASE_YEAR, "last_year": LAST_BASE_YEAR, "first_day_year": None}
    incremental.run(i.spark, typed_source(i), _reference(i), base, **options)
    for name, build in carbon.GOLD.items():
        sinks.write_table(build(i.events), f"{base}/events/{name}")
    prefix = f"viagrid_{base.rsplit('-', 1)[1][:10]}_"
    names = layout.register_all(i.spark, layout.table_paths(i.spark, base, f"{base}/events"), prefix, base)
    return layout.audit_all(i.spark, names).select(
        F.regexp_replace("schema_name", prefix, "").alias("schema_name"), "table_name", "row_count", "table_type"
    )


LAYER_SQL = {
    "bronze": {
        "counts": "annual_typed WHERE year IS NOT NULL", "regions": "region", "local_authorities": "nation", "count_points": "lineitem",
    },
    "silver": {"counts": "annual_counts", "regions": "regions", "local_authorities": "authorities", "count_points": "annual_points"},
    "gold": GOLD_SQL,
    "events": {name: f"({rule('carbon_events')})" for name, rule in EVENT_SQL.items()},
}
add(
    "K11_K12_whole_catalogue", _whole_catalogue,
    " UNION ALL ".join(
        f"SELECT '{layer}' AS schema_name, '{name}' AS table_name, COUNT(*) AS row_count, 'EXTERNAL' AS table_type FROM {source}"
        for layer, tables in LAYER_SQL.items() for name, source in tables.items()
    ),
)
