"""Dashboard measures and chart datasets. Slicers are filters applied first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viagrid.functions import metrics
from viagrid.operators.ranking import top_rows

HOURS = range(24)


def slice_by(df: DataFrame, years: Sequence[int] | None = None, regions: Sequence[str] | None = None) -> DataFrame:
    """Multi-select slicers; no selection means all."""
    if years is not None:
        df = df.filter(F.col("year").isin(*years))
    if regions is not None:
        df = df.filter(F.col("region_name").isin(*regions))
    return df


def _ratio(part, base):
    """Quotient of two sums, 0 where the base is 0 or missing."""
    return F.coalesce(F.try_divide(part, base), F.lit(0.0))


def total_traffic(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("total_all_vehicles").alias("total_traffic"))


def yoy_change(summary: DataFrame) -> DataFrame:
    return summary.agg(metrics.exact_mean(F.col("yoy_change_pct"), 2).alias("yoy_change_pct"))


def ksi_rate(accidents: DataFrame) -> DataFrame:
    rate = _ratio(F.sum("ksi_count"), F.sum("total_collisions")) * 100
    return accidents.agg(rate.alias("ksi_rate"))


def green_index_of_sums(mix: DataFrame) -> DataFrame:
    index = _ratio(F.sum("cycles") + F.sum("buses"), F.sum("total")) * 100
    return mix.agg(index.alias("green_index"))


def green_index_mean(mix: DataFrame) -> DataFrame:
    return mix.agg(metrics.exact_mean(F.col("green_transport_index"), 2).alias("green_index"))


def co2_per_vehicle_of_sums(emissions: DataFrame) -> DataFrame:
    kilograms = metrics.exact_sum(F.col("total_co2_tonnes"), 2) * 1000
    return emissions.agg(_ratio(kilograms, F.sum("total_vehicle_count")).alias("co2_per_vehicle"))


def co2_per_vehicle_mean(emissions: DataFrame) -> DataFrame:
    return emissions.agg(metrics.exact_mean(F.col("co2_per_vehicle_kg"), 2).alias("co2_per_vehicle"))


def recovery(impact: DataFrame) -> DataFrame:
    return impact.agg(metrics.exact_mean(F.col("recovery_pct"), 2).alias("recovery_pct"))


def total_co2(emissions: DataFrame) -> DataFrame:
    return emissions.agg(metrics.exact_sum(F.col("total_co2_tonnes"), 2).alias("total_co2_tonnes"))


def points_observed(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct count points of whatever the slicers left of ``annual.point_bitmaps``, per group of ``by``.

    The bitmaps of a bucket are joined before they are counted, so a point seen
    in several years counts once, and the counts themselves are not read again.
    """
    joined = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("points").alias("points"))
    return joined.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("points")), F.lit(0)).alias("count_points_observed"))


def trend_by_region(mix: DataFrame) -> DataFrame:
    return mix.groupBy("year", "region_name").agg(F.sum("total").alias("total"))


def type_breakdown(mix: DataFrame) -> DataFrame:
    """The kinds shown in the breakdown chart as rows, with their share."""
    kinds = ("cars", "hgvs", "lgvs", "buses", "cycles")
    sums = mix.agg(*(F.sum(kind).alias(kind) for kind in kinds))
    shown = sums.withColumn("shown", metrics.added(kinds))
    return shown.unpivot("shown", list(kinds), "vehicle_type", "vehicles").select(
        "vehicle_type", "vehicles", metrics.percent(F.col("vehicles"), F.col("shown")).alias("share_pct")
    )


def co2_by_region(emissions: DataFrame) -> DataFrame:
    return (
        emissions.groupBy("region_name")
        .agg(metrics.exact_sum(F.col("total_co2_tonnes"), 2).alias("total_co2_tonnes"))
        .orderBy(F.desc("total_co2_tonnes"), "region_name")
    )


def green_index_trend(mix: DataFrame) -> DataFrame:
    index = metrics.exact_mean(F.col("green_transport_index"), 2)
    return mix.groupBy("year", "region_name").agg(index.alias("green_transport_index"))


def weather_by_severity(accidents: DataFrame) -> DataFrame:
    return accidents.groupBy("weather_label", "severity_label").agg(
        F.sum("total_collisions").alias("total_collisions"),
        F.sum("total_casualties").alias("total_casualties"),
    )


def peak_split(peaks: DataFrame) -> DataFrame:
    """Observations and the highest volume in the peaks and outside them."""
    in_peak = F.col("time_period").isin("morning_peak", "evening_peak")
    return peaks.groupBy(F.when(in_peak, "peak").otherwise("off_peak").alias("period")).agg(
        F.sum("observation_count").alias("observations"),
        F.max("max_vehicles").alias("max_vehicles"),
        metrics.exact_mean(F.col("congestion_index"), 3).alias("avg_congestion_index"),
    )


def congestion_heat_map(peaks: DataFrame) -> DataFrame:
    """Congestion index per count point, one column per hour of day."""
    wide = peaks.groupBy("count_point_id").agg(
        *(
            F.max(F.when(F.col("hour") == hour, F.col("congestion_index"))).alias(f"h{hour:02d}")
            for hour in HOURS
        )
    )
    return wide


def top_regions_by_volume(summary: DataFrame, year, n: int = 5) -> DataFrame:
    """Rows of the summary with the highest volumes of a year."""
    return top_rows(
        summary.filter(F.col("year") == year).select(
            "region_name", "road_type", "year", "total_all_vehicles", "yoy_change_pct"
        ),
        n, F.desc("total_all_vehicles"), "region_name", "road_type",
    )
