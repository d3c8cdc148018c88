"""Typed, filtered and labelled tables from raw ones.

Labels are derived after deduplication, so the shuffle carries raw codes only.
None of the tables has a processing time; ``sinks.with_processed_time`` adds it
where a table is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viagrid.functions import cleaning, labels, metrics
from viagrid.functions.cleaning import capitals, conform, day, place, real, stripped, title_case, whole
from viagrid.operators.keyed import one_per_key

PLACE = {"latitude": place, "longitude": place}
VOLUMES = dict.fromkeys((*metrics.VEHICLE_KINDS, "all_motor_vehicles"), whole)

ANNUAL_COUNTS = {
    **dict.fromkeys(("count_point_id", "year", "region_id", "local_authority_id"), whole),
    **PLACE,
    **VOLUMES,
    "link_length_km": real,
    "road_name": capitals,
    "road_type": stripped,
}
HOURLY_COUNTS = {
    **dict.fromkeys(("count_point_id", "year", "hour"), whole),
    "count_date": day("yyyy-MM-dd"),
    "direction_of_travel": capitals,
    **VOLUMES,
}
ANNUAL_POINTS = {"count_point_id": whole, **PLACE, "road_name": capitals}
HOURLY_POINTS = {
    **ANNUAL_POINTS,
    "road_type": stripped,
    "region_name": title_case,
    "local_authority_name": title_case,
}
COLLISIONS = {
    **PLACE,
    **dict.fromkeys(
        ("number_of_vehicles", "number_of_casualties", "speed_limit", "accident_severity",
         "urban_or_rural_area", "light_conditions", "weather_conditions"),
        whole,
    ),
}
VEHICLES = dict.fromkeys(
    ("vehicle_reference", "vehicle_type", "age_of_driver", "age_of_vehicle", "engine_capacity_cc"), whole
)
CASUALTIES = dict.fromkeys(
    ("casualty_reference", "casualty_severity", "age_of_casualty", "casualty_type", "sex_of_casualty"),
    whole,
)


def _with_totals(counts: DataFrame, hgv_base: str) -> DataFrame:
    return counts.withColumn("total_vehicles", metrics.total_vehicles()).withColumn(
        "hgv_percentage", metrics.row_percent(F.col("all_hgvs"), F.col(hgv_base))
    )


def annual_counts(raw: DataFrame) -> DataFrame:
    """Annual average daily flows. HGV share is of motor vehicles; duplicates stay."""
    typed = conform(raw, ANNUAL_COUNTS).filter(F.col("year").isNotNull() & cleaning.within_area())
    return _with_totals(typed, "all_motor_vehicles")


def annual_count_points(raw: DataFrame) -> DataFrame:
    return one_per_key(conform(raw, ANNUAL_POINTS).filter(cleaning.within_area()), ["count_point_id"])


def named_areas(raw: DataFrame, typed_id: bool = True) -> DataFrame:
    """Regions or local authorities: a tidy name, one row per id."""
    contract = {"id": whole, "name": title_case} if typed_id else {"name": title_case}
    return one_per_key(conform(raw, contract), ["id"])


def hourly_count_points(raw: DataFrame) -> DataFrame:
    named = raw.withColumnRenamed("id", "count_point_id")
    placed = conform(named, HOURLY_POINTS).filter(cleaning.within_area())
    return one_per_key(placed, ["count_point_id"])


def hourly_counts(
    raw: DataFrame, first_year: int | None = cleaning.FIRST_COUNT_YEAR, last_year: int | None = None
) -> DataFrame:
    """Hourly counts. HGV share is of all vehicles; one row per point, hour and direction.

    Years outside the window are left out; ``rejected_years`` counts them.
    """
    typed = conform(raw, HOURLY_COUNTS).filter(
        cleaning.all_present("count_point_id") & cleaning.within_years(first_year, last_year)
    )
    kept = one_per_key(typed, ["count_point_id", "year", "count_date", "hour", "direction_of_travel"])
    return _with_totals(kept, "total_vehicles").withColumn(
        "time_period", labels.count_period(F.col("hour"))
    )


def rejected_years(
    raw: DataFrame, first_year: int | None = cleaning.FIRST_COUNT_YEAR, last_year: int | None = None
) -> DataFrame:
    """Rows per year that the window of ``hourly_counts`` rejects; unreadable years are under NULL."""
    years = conform(raw.select("year"), {"year": whole})
    return years.filter(~cleaning.within_years(first_year, last_year)).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


def collisions(raw: DataFrame) -> DataFrame:
    named = raw.withColumnRenamed("accident_index", "collision_id")
    kept = one_per_key(conform(named, COLLISIONS).filter(cleaning.within_area()), ["collision_id"])
    dated = kept.withColumn("collision_date", day("dd/MM/yyyy")(F.col("date")))
    return dated.withColumns(
        {
            "collision_year": F.year("collision_date"),
            "collision_month": F.month("collision_date"),
            "day_of_week": F.dayofweek("collision_date"),
            "severity_label": labels.severity(F.col("accident_severity")),
            "is_urban": labels.is_urban(F.col("urban_or_rural_area")),
            "light_condition_label": labels.light(F.col("light_conditions")),
            "weather_label": labels.weather(F.col("weather_conditions")),
        }
    )


def vehicles(raw: DataFrame) -> DataFrame:
    named = raw.withColumnRenamed("accident_index", "collision_id")
    kept = one_per_key(conform(named, VEHICLES), ["collision_id", "vehicle_reference"])
    return kept.withColumns(
        {
            "vehicle_type_label": labels.vehicle_type(F.col("vehicle_type")),
            "driver_age_band": labels.driver_age_band(F.col("age_of_driver")),
        }
    )


def casualties(raw: DataFrame) -> DataFrame:
    named = raw.withColumnRenamed("accident_index", "collision_id")
    kept = one_per_key(conform(named, CASUALTIES), ["collision_id", "casualty_reference"])
    return kept.withColumns(
        {
            "casualty_severity_label": labels.severity(F.col("casualty_severity")),
            "casualty_age_band": labels.casualty_age_band(F.col("age_of_casualty")),
            "casualty_type_label": labels.casualty_type(F.col("casualty_type")),
            "sex_label": labels.sex(F.col("sex_of_casualty")),
        }
    )
