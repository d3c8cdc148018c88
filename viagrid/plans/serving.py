"""Views for reporting tools."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viagrid.functions import labels
from viagrid.operators.lookup import with_point
from viagrid.sources.landed import folder_view

# View names and the gold folders they show.
BATCH_VIEWS = {
    "vw_traffic_summary": "fact_traffic_summary",
    "vw_co2_emissions": "fact_co2_emissions",
    "vw_vehicle_mix": "fact_vehicle_mix",
    "vw_road_analysis": "fact_road_analysis",
    "vw_covid_impact": "fact_covid_impact",
    "vw_busiest_roads": "fact_busiest_roads",
    "vw_dim_location": "dim_location",
    "vw_dim_date": "dim_date",
}
# Names of the sums or views, and what they are of.
EVENT_VIEWS = {
    "vw_stream_national_intensity": "gold_national_intensity",
    "vw_stream_generation_mix": "gold_generation_mix",
    "vw_stream_regional_intensity": "gold_regional_intensity",
    "vw_stream_regional_generation": "gold_regional_generation",
    "vw_stream_renewable_summary": "gold_renewable_summary",
}

PLACE = ["region_name", "local_authority_name", "road_name", "road_type", "road_category",
         "latitude", "longitude"]


def folder_views(spark: SparkSession, base: str, views: Mapping[str, str]) -> dict[str, DataFrame]:
    """One pass-through view per gold folder."""
    return {name: folder_view(spark, name, f"{base.rstrip('/')}/{folder}") for name, folder in views.items()}


def publish(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def traffic_summary(daily: DataFrame, point_dim: DataFrame, dates: DataFrame, yoy: DataFrame) -> DataFrame:
    """Daily volumes with place, calendar and the growth of the year."""
    calendar_columns = dates.select(
        F.col("date").alias("count_date"), "year", "month", "month_name", "quarter",
        "fiscal_year", "day_name", "is_weekend",
    )
    growth = yoy.select(
        "region_name", "road_type", "year", "yoy_change_pct",
        F.col("total_vehicles").alias("annual_total_vehicles"),
    )
    return (
        with_point(daily.drop("year"), point_dim, PLACE)
        .join(calendar_columns, "count_date")
        .join(growth, ["region_name", "road_type", "year"], "left")
        .select(
            "year", "month", "month_name", "quarter", "fiscal_year", "day_name", "is_weekend",
            *PLACE,
            "total_all_vehicles", "total_cars", "total_hgvs", "total_buses", "total_lgvs",
            "total_pedal_cycles", "total_motorcycles", "motorised_vehicles", "freight_vehicles",
            "active_travel_vehicles", "avg_hgv_percentage", "hours_counted",
            "yoy_change_pct", "annual_total_vehicles",
        )
    )


def accident_hotspots(hotspots: DataFrame) -> DataFrame:
    return hotspots.select(
        "lat_grid", "lon_grid", "collision_year", "total_incidents", "fatal_incidents",
        "serious_incidents", "total_casualties", "avg_speed_limit", "is_urban",
        "severity_score", "hotspot_rank",
        labels.risk_category(F.col("hotspot_rank")).alias("risk_category"),
    )


def accident_trends(summary: DataFrame, null_label: str | None = None) -> DataFrame:
    return summary.select(
        "collision_year", "collision_month", "severity_label", "weather_label",
        "light_condition_label", "is_urban", "speed_limit", "total_collisions",
        "total_casualties", "fatal_count", "serious_count", "slight_count", "ksi_count", "ksi_rate",
        labels.speed_band(F.col("speed_limit"), null_label).alias("speed_band"),
        labels.area_type(F.col("is_urban")).alias("area_type"),
    )


def co2_emissions(emissions: DataFrame, null_label: str | None = None) -> DataFrame:
    band = labels.emission_category(F.col("co2_per_vehicle_kg"), null_label)
    return emissions.withColumn("emission_category", band)


def green_transport(mix: DataFrame, null_label: str | None = None) -> DataFrame:
    tier = labels.sustainability_tier(F.col("green_transport_index"), null_label)
    return mix.drop("prev_green_index").withColumn("sustainability_tier", tier)


def congestion_analysis(peaks: DataFrame, point_dim: DataFrame, null_label: str | None = None) -> DataFrame:
    return with_point(peaks, point_dim, PLACE).select(
        "year", "hour", "time_period", *PLACE,
        "avg_vehicles", "max_vehicles", "min_vehicles", "avg_cars", "avg_hgvs",
        "observation_count", "congestion_index",
        labels.congestion_level(F.col("congestion_index"), null_label).alias("congestion_level"),
        labels.period_sort_order(F.col("time_period")).alias("time_period_sort_order"),
    )
