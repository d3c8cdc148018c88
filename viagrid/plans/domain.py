"""One run over the hourly counts and the collisions: raw, silver, gold.

Collisions, vehicles and casualties go through silver like the counts do, so the
safety tables never rest on a step that was left out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from viagrid.operators.quarantine import Gate, checked, put_aside
from viagrid.plans import dates, hourly, safety, silver
from viagrid.session import remove_folder, short_methods, side_by_side, work_folder
from viagrid.sources import sinks

# Table -> the column its folders are partitioned by.
SILVER_LAYOUT = {
    "count_points": (),
    "counts": ("year",),
    "regions": (),
    "local_authorities": (),
    "collisions": ("collision_year",),
    "vehicles": (),
    "casualties": (),
}
GOLD_LAYOUT = {
    "fact_daily_traffic": ("year",),
    "fact_hourly_peaks": ("year",),
    "fact_yoy_regional": (),
    "dim_count_point": (),
    "dim_date": (),
    "fact_co2_emissions": ("year",),
    "fact_vehicle_mix": (),
    "fact_active_travel": (),
    "fact_accident_summary": ("collision_year",),
    "fact_accident_hotspots": ("collision_year",),
    "fact_casualty_demographics": ("collision_year",),
    "fact_vehicle_analysis": ("collision_year",),
    "fact_time_patterns": (),
}


def silver_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "count_points": silver.hourly_count_points(raw["count_points"]),
        "counts": silver.hourly_counts(raw["counts"]),
        "regions": silver.named_areas(raw["regions"], typed_id=False),
        "local_authorities": silver.named_areas(raw["local_authorities"], typed_id=False),
        "collisions": silver.collisions(raw["collisions"]),
        "vehicles": silver.vehicles(raw["vehicles"]),
        "casualties": silver.casualties(raw["casualties"]),
    }


def gold_tables(
    tables: Mapping[str, DataFrame], days: DataFrame, yearly: DataFrame | None = None,
    bucketed: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The thirteen gold tables; ``yearly`` are the point years, ``bucketed`` the tables of ``safety.by_collision``, where they are stored."""
    counts, points, collisions = (tables[name] for name in ("counts", "count_points", "collisions"))
    if yearly is None:
        yearly = hourly.point_years(counts)
    if bucketed is None:
        demographics = safety.casualty_demographics(tables["casualties"], collisions)
        analysis = safety.vehicle_analysis(tables["vehicles"], collisions)
    else:
        demographics = safety.demographics_from(bucketed["collision_casualties"], bucketed["collision_keys"])
        analysis = safety.analysis_from(bucketed["collision_vehicles"], bucketed["collision_keys"])
    return {
        "fact_daily_traffic": hourly.daily_traffic(counts),
        "fact_hourly_peaks": hourly.hourly_peaks(counts),
        "fact_yoy_regional": hourly.yoy_from(yearly, points),
        "dim_count_point": hourly.count_point_dim(points),
        "dim_date": dates.date_dim_fiscal(days),
        "fact_co2_emissions": hourly.co2_from(yearly, points),
        "fact_vehicle_mix": hourly.mix_from(yearly, points),
        "fact_active_travel": hourly.travel_from(yearly, points),
        "fact_accident_summary": safety.accident_summary(collisions),
        "fact_accident_hotspots": safety.accident_hotspots(collisions),
        "fact_casualty_demographics": demographics,
        "fact_vehicle_analysis": analysis,
        "fact_time_patterns": safety.time_patterns(collisions),
    }


def run(
    spark: SparkSession, raw: Mapping[str, DataFrame], base: str, days: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    gate: Gate | None = None, schema: str | None = None, buckets: int = 64,
) -> dict[str, str]:
    """Write silver and gold below ``base``; returns the gold paths.

    Counts are summed per point and year once, into the work folder; four gold
    tables read that instead of the counts. The date dimension ends with the last
    year counted, unless ``days`` are given, or made of the stored counts by a
    function like ``dates.spine_of``. Tables that do not depend on each other
    are written side by side.

    With a gate, all silver tables are computed into the work folder and held
    against it before anything is written below ``base``. Rows that break a
    rule then go to ``quarantine/<table>`` with the names of the rules instead
    of silver, and ``quality`` holds the report on all tables.

    With a schema of the catalog, the tables of ``safety.by_collision`` are
    registered there in buckets of the collision, stored below ``bucketed``;
    gold and whoever joins them later moves no row of theirs.
    """
    short_methods(spark)
    kept = work_folder(spark, "domain-run")
    try:
        tables = silver_tables(raw)
        if gate is not None:
            masked = side_by_side(spark, [partial(checked, spark, df, name, gate, f"{kept}/{name}") for name, df in tables.items()])
            passed = dict(zip(tables, masked, strict=True))
            reports = [found.report for found in passed.values()]
            sinks.write_table(reduce(DataFrame.unionByName, reports).coalesce(1), f"{base}/quality")
            for name, found in passed.items():
                put_aside(spark, found, f"{base}/quarantine/{name}")
            tables = {name: found.good for name, found in passed.items()}
        side_by_side(
            spark, [partial(sinks.write_table, sinks.with_processed_time(df), f"{base}/silver/{name}", SILVER_LAYOUT[name]) for name, df in tables.items()]
        )
        stored = {name: spark.read.parquet(f"{base}/silver/{name}") for name in SILVER_LAYOUT}
        bucketed = None if schema is None else store_by_collision(spark, stored, schema, f"{base}/bucketed", buckets)
        return _write_gold(spark, stored, f"{kept}/point-years", base, days, bucketed)
    finally:
        remove_folder(spark, kept)


def store_by_collision(
    spark: SparkSession, tables: Mapping[str, DataFrame], schema: str, base: str, buckets: int
) -> dict[str, DataFrame]:
    """Write the tables of ``safety.by_collision`` in buckets and register them."""
    made = safety.by_collision(tables["vehicles"], tables["casualties"], tables["collisions"])
    return {name: sinks.write_bucketed(df, f"{schema}.{name}", f"{base}/{name}", "collision_id", buckets) for name, df in made.items()}


def _write_gold(
    spark: SparkSession, stored: Mapping[str, DataFrame], kept: str, base: str,
    days: DataFrame | Callable[[DataFrame], DataFrame] | None, bucketed: Mapping[str, DataFrame] | None,
) -> dict[str, str]:
    sinks.write_table(hourly.point_years(stored["counts"]), kept)
    if days is None:
        days = dates.spine_of(stored["counts"], dates.FIRST_YEAR)
    elif callable(days):
        days = days(stored["counts"])
    tables = gold_tables(stored, days, spark.read.parquet(kept), bucketed)
    paths = {name: f"{base}/gold/{name}" for name in tables}
    side_by_side(spark, [partial(sinks.write_table, df, paths[name], GOLD_LAYOUT[name]) for name, df in tables.items()])
    return paths
