"""Gold tables on annual average daily flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viagrid.functions import labels, metrics
from viagrid.functions.cleaning import within_years
from viagrid.operators.compare import base_value, previous, with_change, with_growth
from viagrid.operators.lookup import with_authority, with_region
from viagrid.operators.keyed import one_per_key
from viagrid.operators.ranking import dense_top

GROUP = ["region_name", "road_type"]
#: The stored table of ``point_bitmaps``, which may have no rows.
POINTS = "region_name string, road_type string, bucket long, points binary, year int"

# Fixed values. Sums of the traffic summary and of the vehicle mix: output name, counted column.
SUMMARY_SUMS = {
    "total_cars": "cars_and_taxis",
    "total_buses": "buses_and_coaches",
    "total_lgvs": "lgvs",
    "total_hgvs": "all_hgvs",
    "total_cycles": "pedal_cycles",
    "total_motorcycles": "two_wheeled_motor_vehicles",
    "total_motor_vehicles": "all_motor_vehicles",
    "total_all_vehicles": "total_vehicles",
}
# Names of the sums or views, and what they are of.
MIX_SUMS = {
    "cycles": "pedal_cycles",
    "motorcycles": "two_wheeled_motor_vehicles",
    "cars": "cars_and_taxis",
    "buses": "buses_and_coaches",
    "lgvs": "lgvs",
    "hgvs": "all_hgvs",
    "total": "total_vehicles",
}
# Names of the sums or views, and what they are of.
MOTOR_SUMS = {
    "total_vehicles": "all_motor_vehicles",
    "total_hgvs": "all_hgvs",
    "total_cycles": "pedal_cycles",
}


def sums(names: dict[str, str]) -> list[Column]:
    return [F.sum(source).alias(name) for name, source in names.items()]


def regional_totals(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """Everything summed per region, road type and year.

    Summary, CO2, vehicle mix and base-year comparison all follow from it, so a
    run that builds them together reads the counts once. A table built on its
    own computes only the sums it needs, as Catalyst drops the rest.
    """
    volumes = (*metrics.VEHICLE_KINDS, "all_motor_vehicles", "total_vehicles")
    return (
        with_region(counts, regions)
        .groupBy(*GROUP, "year")
        .agg(
            *sums({name: name for name in volumes}),
            *co2_sums({"car_co2": "cars_and_taxis", "hgv_co2": "all_hgvs"}),
            F.count_distinct("count_point_id").alias("count_points_observed"),
            metrics.exact_mean(F.col("hgv_percentage"), 2).alias("avg_hgv_pct"),
        )
    )


def totals_with_points(counts: DataFrame, regions: DataFrame, points: DataFrame) -> DataFrame:
    """``regional_totals`` where ``point_bitmaps`` of these counts are stored: distinct points are counted in these.

    So no count point is shuffled; everything is summed per id of a region
    first, as the names are joined and summed once more as a few rows.
    """
    volumes = (*metrics.VEHICLE_KINDS, "all_motor_vehicles", "total_vehicles")
    share = metrics.long_units(F.col("hgv_percentage"), 2)
    by_id = counts.groupBy("region_id", "road_type", "year").agg(
        *sums({name: name for name in volumes}),
        *co2_sums({"car_co2": "cars_and_taxis", "hgv_co2": "all_hgvs"}),
        metrics.sum_of_units(share).alias("_share"),
        F.count(share).alias("_shares"),
    )
    added_up = (*volumes, "total_co2", "car_co2", "hgv_co2")
    totals = with_region(by_id, regions).groupBy(*GROUP, "year").agg(
        *sums({name: name for name in added_up}),
        metrics.mean_of_units(F.sum("_share"), F.sum("_shares"), 2).alias("avg_hgv_pct"),
    )
    seen = points.groupBy(*(F.col(name).alias(f"_{name}") for name in (*GROUP, "year"))).agg(F.sum(F.bitmap_count("points")).alias("_seen"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in (*GROUP, "year")]
    observed = F.coalesce("_seen", F.lit(0).cast("bigint")).alias("count_points_observed")
    return totals.join(seen, same, "left").select(*GROUP, "year", *added_up, observed, "avg_hgv_pct")


def point_bitmaps(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """The count points seen per region, road type and year, as exact bitmaps of their ids.

    Unlike a distinct count these can be put together over years and regions.
    A bucket of 32,768 ids is one bitmap of 4 KB; each task sends one per group.
    """
    point = F.col("count_point_id").cast("bigint")
    return (
        with_region(counts, regions)
        .filter(point.isNotNull())
        .groupBy(*GROUP, "year", F.bitmap_bucket_number(point).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(point)).alias("points"))
    )


def _renamed(names: dict[str, str]) -> list[Column]:
    return [F.col(source).alias(name) for name, source in names.items()]


def summary_from(totals: DataFrame, strict: bool = False) -> DataFrame:
    summary = totals.select(
        *GROUP, "year", *_renamed(SUMMARY_SUMS), "count_points_observed", "avg_hgv_pct"
    ).withColumns(
        {
            "freight_vehicles": metrics.added(["total_lgvs", "total_hgvs"]),
            "green_transport_index": metrics.green_index(
                "total_cycles", "total_buses", "total_all_vehicles"
            ),
        }
    )
    return with_growth(
        summary, "total_all_vehicles", GROUP, "prev_year_vehicles", "yoy_change_pct", strict
    )


def traffic_summary(counts: DataFrame, regions: DataFrame, strict: bool = False) -> DataFrame:
    """Volumes, HGV share, freight and green index per region, road type and year."""
    return summary_from(regional_totals(counts, regions), strict)


def with_co2(counts: DataFrame) -> DataFrame:
    """Per-row CO2 estimates in kg by kind of vehicle, and their sum."""
    names = {f"co2_{kind}_kg": metrics.co2_kg(kind) for kind in metrics.VEHICLE_KINDS}
    hundredths = metrics.added(metrics.co2_hundredths(kind) for kind in metrics.VEHICLE_KINDS)
    return counts.withColumns({**names, "total_co2_kg": hundredths / F.lit(100.0)})


def co2_sums(kinds: dict[str, str]) -> list[Column]:
    """Exact sums of 0.01 kg: the total first, then the kinds asked for."""
    total = metrics.added(metrics.co2_hundredths(kind) for kind in metrics.VEHICLE_KINDS)
    return [
        F.sum(total).alias("total_co2"),
        *(F.sum(metrics.co2_hundredths(kind)).alias(name) for name, kind in kinds.items()),
    ]


def co2_from(totals: DataFrame) -> DataFrame:
    weights = ("total_co2", "car_co2", "hgv_co2")
    return totals.select(
        *GROUP,
        "year",
        *(metrics.tonnes(F.col(name)).alias(f"{name}_tonnes") for name in weights),
        F.col("all_motor_vehicles").alias("total_vehicle_count"),
    ).withColumn("co2_per_vehicle_kg", co2_per_vehicle())


def co2_emissions(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """CO2 per region, road type and year; the count is of motor vehicles."""
    return co2_from(regional_totals(counts, regions))


def co2_per_vehicle() -> Column:
    return metrics.quotient(F.col("total_co2_tonnes") * 1000, F.col("total_vehicle_count"), 2)


def mix_shares(totals: DataFrame, by: list[str], strict: bool = False) -> DataFrame:
    """Shares of the vehicle kinds, the green index and its change over the year before."""
    shared = totals.withColumns(
        {
            **{
                f"{kind}_share_pct": metrics.percent(F.col(column), F.col("total"))
                for kind, column in (("car", "cars"), ("cycle", "cycles"), ("hgv", "hgvs"), ("bus", "buses"))
            },
            "green_transport_index": metrics.green_index("cycles", "buses", "total"),
        }
    )
    return with_change(
        shared, "green_transport_index", by, "prev_green_index", "green_index_change", strict
    )


def mix_from(counted: DataFrame, strict: bool = False) -> DataFrame:
    """The mix from counts or totals that carry a region name."""
    totals = counted.groupBy("region_name", "year").agg(*sums(MIX_SUMS))
    return mix_shares(totals, ["region_name"], strict)


def vehicle_mix(counts: DataFrame, regions: DataFrame, strict: bool = False) -> DataFrame:
    return mix_from(with_region(counts, regions), strict)


def road_analysis(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """Volumes and vehicles per km of each road."""
    return (
        with_region(counts, regions)
        .withColumn("road_class", labels.road_class(F.col("road_category")))
        .groupBy("region_name", "road_class", "road_name", "year")
        .agg(
            F.sum("all_motor_vehicles").alias("total_motor_vehicles"),
            F.sum("all_hgvs").alias("total_hgvs"),
            F.sum("pedal_cycles").alias("total_cycles"),
            metrics.exact_mean(F.col("link_length_km"), 6).alias("avg_link_length_km"),
            F.count_distinct("count_point_id").alias("count_points"),
        )
        .withColumn(
            "vehicles_per_km",
            metrics.quotient(F.col("total_motor_vehicles"), F.col("avg_link_length_km"), 0),
        )
    )


def impact_from(
    totals: DataFrame, base_year: int = 2019, last_year: int | None = None, base_name: str | None = None
) -> DataFrame:
    base_name = base_name or f"baseline_{base_year}"
    volume = F.col("total_vehicles")
    return (
        totals.filter(within_years(base_year, last_year))
        .select(*GROUP, "year", *_renamed(MOTOR_SUMS))
        .withColumns(
            {
                base_name: base_value("total_vehicles", GROUP, base_year),
                "yoy_change": metrics.change(volume, previous("total_vehicles", GROUP), 0),
            }
        )
        .withColumn("recovery_pct", metrics.percent(volume, F.col(base_name)))
    )


def covid_impact(
    counts: DataFrame, regions: DataFrame, base_year: int = 2019, last_year: int | None = None,
    base_name: str | None = None,
) -> DataFrame:
    """Motor volumes from a base year on (to the last counted by default), as a percentage of the base year."""
    return impact_from(regional_totals(counts, regions), base_year, last_year, base_name)


def latest_year(counts: DataFrame) -> Column:
    """The last year present, as a scalar subquery."""
    return counts.agg(F.max("year")).scalar()


def road_totals(counts: DataFrame, regions: DataFrame, year: int | None = None) -> DataFrame:
    """Motor volumes of the roads of one year, the last one by default."""
    wanted = F.lit(year) if year is not None else latest_year(counts)
    return (
        with_region(counts.filter(F.col("year") == wanted), regions)
        .groupBy("region_name", "road_name", "road_type", "latitude", "longitude")
        .agg(*sums(MOTOR_SUMS))
    )


def busiest_from(totals: DataFrame, ranks: int = 500) -> DataFrame:
    """The roads with the highest volumes, from ``road_totals``, best stored as they are read twice."""
    return dense_top(totals, "total_vehicles", ranks)


def busiest_roads(
    counts: DataFrame, regions: DataFrame, year: int | None = None, ranks: int = 500
) -> DataFrame:
    """Roads of one year (the last one by default) with the highest motor volumes."""
    return busiest_from(road_totals(counts, regions, year), ranks)


def yearly_locations(counts: DataFrame, regions: DataFrame, authorities: DataFrame) -> DataFrame:
    """One row per count point and year with its road, region and authority."""
    placed = with_authority(with_region(counts, regions), authorities).select(
        "count_point_id", "year", "road_name", "road_type", "road_category",
        "region_name", "local_authority_name", "latitude", "longitude",
    )
    return one_per_key(placed, ["count_point_id", "year"])


def location_from(yearly: DataFrame) -> DataFrame:
    """One row per count point, of all its years."""
    return one_per_key(yearly.drop("year"), ["count_point_id"]).withColumn(
        "road_class", labels.road_class(F.col("road_category"))
    )


def location(counts: DataFrame, regions: DataFrame, authorities: DataFrame) -> DataFrame:
    """One row per count point with its road, region and authority."""
    return location_from(yearly_locations(counts, regions, authorities))
