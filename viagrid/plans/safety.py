"""Gold tables on road collisions.

Vehicles and casualties meet the collisions with the few columns that are
counted, in a join that AQE splits where a collision holds most rows, and are
counted from there: a collision has a handful of rows, so that counting them per
collision and label first would shuffle and hash nearly as many. ``by_collision``
does that once for tables that are stored in buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viagrid.functions import calendar, labels, metrics
from viagrid.operators.ranking import dense_rank_within


# Keys and output columns of the collision summary and of the hotspot cells.
SUMMARY_KEYS = (
    "collision_year", "collision_month", "severity_label", "weather_label", "light_condition_label", "is_urban", "speed_limit",
)
SUMMARY_SEVERITIES = {"fatal_count": "Fatal", "serious_count": "Serious", "slight_count": "Slight"}
CELL_SEVERITIES = {"fatal_incidents": "Fatal", "serious_incidents": "Serious"}
CELL_DIGITS = 2


def _severity_counts(names: dict[str, str]) -> dict[str, Column]:
    return {name: F.count_if(F.col("severity_label") == label) for name, label in names.items()}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def accident_summary(collisions: DataFrame) -> DataFrame:
    """Collisions, casualties and the share of killed or seriously injured."""
    counts = {
        **_severity_counts(SUMMARY_SEVERITIES),
        "total_collisions": F.count("collision_id"),
        "total_casualties": F.sum("number_of_casualties"),
        "total_vehicles_involved": F.sum("number_of_vehicles"),
        "avg_casualties_per_collision": F.avg("number_of_casualties"),
    }
    ksi = metrics.added(["fatal_count", "serious_count"])
    summed = collisions.groupBy(*SUMMARY_KEYS).agg(*_named(counts))
    return summed.withColumns({"ksi_count": ksi, "ksi_rate": metrics.percent(ksi, F.col("total_collisions"))})


def accident_hotspots(collisions: DataFrame) -> DataFrame:
    """Collisions per 0.01 degree cell and year, ranked within the year.

    The area bounds of the silver table limit a year to 1201 x 1001 cells, which
    is what the ranking of a year sorts in one task. A cell with urban and rural
    collisions is rural.
    """
    grid = {"lat_grid": F.round("latitude", CELL_DIGITS), "lon_grid": F.round("longitude", CELL_DIGITS)}
    counts = {
        "is_urban": F.min("is_urban"),
        "avg_speed_limit": F.avg("speed_limit"),
        "total_casualties": F.sum("number_of_casualties"),
        **_severity_counts(CELL_SEVERITIES),
        "total_incidents": F.count("collision_id"),
    }
    score = metrics.severity_score(F.col("total_incidents"), *(F.col(name) for name in CELL_SEVERITIES))
    cells = collisions.groupBy("collision_year", *_named(grid)).agg(*_named(counts)).withColumn("severity_score", score)
    return dense_rank_within(cells, ["collision_year"], "severity_score", "hotspot_rank")


CASUALTY_GROUP = ("casualty_severity_label", "casualty_type_label", "casualty_age_band", "sex_label")
VEHICLE_GROUP = ("vehicle_type_label", "driver_age_band")


def casualties_by_collision(casualties: DataFrame) -> DataFrame:
    """Casualties counted per collision and labels."""
    return casualties.groupBy("collision_id", *CASUALTY_GROUP).agg(F.count(F.lit(1)).alias("n"))


def demographics_from(counted: DataFrame, collisions: DataFrame) -> DataFrame:
    return (
        counted.join(collisions.select("collision_id", "collision_year", "is_urban"), "collision_id")
        .groupBy("collision_year", *CASUALTY_GROUP, "is_urban")
        .agg(F.sum("n").alias("casualty_count"))
    )


def casualty_demographics(casualties: DataFrame, collisions: DataFrame) -> DataFrame:
    """Casualties counted by year and labels, as ``demographics_from`` has them."""
    met = casualties.select("collision_id", *CASUALTY_GROUP).join(
        collisions.select("collision_id", "collision_year", "is_urban"), "collision_id"
    )
    return met.groupBy("collision_year", *CASUALTY_GROUP, "is_urban").agg(F.count(F.lit(1)).alias("casualty_count"))


def vehicles_by_collision(vehicles: DataFrame) -> DataFrame:
    """Vehicles counted per collision and labels, with what their mean age and engine size follow from."""
    return vehicles.groupBy("collision_id", *VEHICLE_GROUP).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("age_of_vehicle").alias("age_sum"),
        F.count("age_of_vehicle").alias("age_n"),
        F.sum("engine_capacity_cc").alias("cc_sum"),
        F.count("engine_capacity_cc").alias("cc_n"),
    )


def analysis_from(counted: DataFrame, collisions: DataFrame) -> DataFrame:
    return (
        counted.join(collisions.select("collision_id", "collision_year", "severity_label"), "collision_id")
        .groupBy("collision_year", *VEHICLE_GROUP, "severity_label")
        .agg(
            F.sum("n").alias("vehicle_count"),
            F.try_divide(F.sum("age_sum"), F.sum("age_n")).alias("avg_vehicle_age"),
            F.try_divide(F.sum("cc_sum"), F.sum("cc_n")).alias("avg_engine_cc"),
        )
    )


def vehicle_analysis(vehicles: DataFrame, collisions: DataFrame) -> DataFrame:
    """Vehicles involved, with mean age and engine size, as ``analysis_from`` has them."""
    met = vehicles.select("collision_id", *VEHICLE_GROUP, "age_of_vehicle", "engine_capacity_cc").join(
        collisions.select("collision_id", "collision_year", "severity_label"), "collision_id"
    )
    return met.groupBy("collision_year", *VEHICLE_GROUP, "severity_label").agg(
        F.count(F.lit(1)).alias("vehicle_count"),
        F.try_divide(F.sum("age_of_vehicle"), F.count("age_of_vehicle")).alias("avg_vehicle_age"),
        F.try_divide(F.sum("engine_capacity_cc"), F.count("engine_capacity_cc")).alias("avg_engine_cc"),
    )


def by_collision(vehicles: DataFrame, casualties: DataFrame, collisions: DataFrame) -> dict[str, DataFrame]:
    """What the joins on collisions need, per collision, to be stored in buckets of their id.

    Rows of a collision are combined before they are bucketed, partly before
    any shuffle, so no bucket grows with the vehicles or casualties of one
    collision, and joins of these tables move no row.
    """
    return {
        "collision_keys": collisions.select("collision_id", "collision_year", "is_urban", "severity_label"),
        "collision_vehicles": vehicles_by_collision(vehicles),
        "collision_casualties": casualties_by_collision(casualties),
    }


def time_patterns(collisions: DataFrame) -> DataFrame:
    """Collisions by weekday, hour and part of the day."""
    is_text = isinstance(collisions.schema["time"].dataType, T.StringType)
    hour = calendar.clock_hour(F.col("time")) if is_text else F.hour("time")
    return (
        collisions.withColumn("hour", hour)
        .withColumn("time_period", labels.collision_period(F.col("hour")))
        .groupBy("collision_year", "day_of_week", "hour", "time_period", "severity_label")
        .agg(
            F.count("collision_id").alias("collision_count"),
            F.sum("number_of_casualties").alias("casualty_count"),
        )
    )
