"""Domain inputs derived row by row from the driver's tables.

Whole tables are read; the derivations add the dirt the silver rules are there
for: sentinels for missing values, padding, places out of bounds, repeats.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viagrid.plans import annual, dates, hourly, safety, silver
from viagrid.streaming import carbon, payload

# The stand-in years are 1995..2001; 1996 takes the role of the base year.
BASE_YEAR, LAST_BASE_YEAR = 1996, 2001


def annual_raw(lineitem: DataFrame) -> DataFrame:
    """Annual flows, all text: one row per line item, count points are parts."""
    return lineitem.selectExpr(
        "cast(l_partkey as string) as count_point_id",
        "case when l_orderkey % 101 = 0 then 'None' else cast(year(l_shipdate) as string) end as year",
        "cast(l_partkey % 6 as string) as region_id",
        "cast(l_partkey % 25 as string) as local_authority_id",
        "concat(' a', l_partkey % 200, ' ') as road_name",
        "element_at(array('PA', 'TA', 'TM', 'M', 'MCU'), cast((l_partkey + l_linenumber) % 5 as int) + 1)"
        " as road_category",
        "case l_suppkey % 3 when 0 then ' Major ' when 1 then 'Minor ' else 'Other' end as road_type",
        "case when l_orderkey % 89 = 0 then 'nan'"
        " else cast((485 + l_partkey % 130) / 10.0D as string) end as latitude",
        "cast((l_partkey % 110 - 85) / 10.0D as string) as longitude",
        "case when l_orderkey % 113 = 0 then 'Infinity'"
        " else cast((1 + l_partkey % 50) / 10.0D as string) end as link_length_km",
        "cast(cast(l_quantity as int) as string) as pedal_cycles",
        "cast(l_suppkey % 20 as string) as two_wheeled_motor_vehicles",
        "case when l_orderkey % 7 = 0 then cast(floor(l_extendedprice / 10) || '.0' as string)"
        " else cast(floor(l_extendedprice / 10) as string) end as cars_and_taxis",
        "cast(l_suppkey % 30 as string) as buses_and_coaches",
        "cast(floor(l_extendedprice / 50) as string) as lgvs",
        "case when l_orderkey % 97 = 0 then 'None' when l_orderkey % 103 = 0 then '12.abc'"
        " when l_orderkey % 107 = 0 then '7.8.9' when l_orderkey % 109 = 0 then '1.5e3'"
        " when l_orderkey % 1999 = 0 then '2147483647'"
        " else cast(floor(l_extendedprice / 100) as string) end as all_hgvs",
        "cast(l_suppkey % 20 + floor(l_extendedprice / 10) + l_suppkey % 30"
        " + floor(l_extendedprice / 50) + floor(l_extendedprice / 100) as string) as all_motor_vehicles",
    )


def annual_points_raw(lineitem: DataFrame) -> DataFrame:
    """Count points, all text, with many rows per point."""
    return annual_raw(lineitem).select(
        "count_point_id", "region_id", "local_authority_id",
        "road_name", "road_category", "road_type", "latitude", "longitude",
    )


def regions_raw(region: DataFrame) -> DataFrame:
    return region.selectExpr(
        "cast(r_regionkey as string) as id", "lower(concat('  ', r_name, ' ')) as name"
    )


def authorities_raw(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(
        "cast(n_nationkey as string) as id",
        "lower(concat(' ', n_name)) as name",
        "cast(n_regionkey as string) as region_id",
    )


def hourly_points_raw(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey as id",
        "concat(' a', c_custkey % 200, ' ') as road_name",
        "case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'Major '"
        " when c_mktsegment = 'FURNITURE' then 'Other' else ' Minor' end as road_type",
        "concat(' region ', c_nationkey % 5, ' ') as region_name",
        "concat('AUTHORITY ', c_nationkey) as local_authority_name",
        "case when c_custkey % 53 = 0 then null else (480 + c_custkey % 140) / 10.0D end as latitude",
        "(c_custkey % 120 - 90) / 10.0D as longitude",
    )


def hourly_raw(events: DataFrame) -> DataFrame:
    """Hourly counts; dates are moved back by up to five years, one in seven by thirty."""
    moved = events.withColumn(
        "count_day",
        F.expr(
            "add_months(cast(ts as date),"
            " -12 * cast(case when event_id % 7 = 6 then 30 else event_id % 7 end as int))"
        ),
    )
    return moved.selectExpr(
        "user_id as count_point_id",
        "year(count_day) as year",
        "date_format(count_day, 'yyyy-MM-dd') as count_date",
        "hour(ts) as hour",
        "case event_id % 4 when 0 then ' n' when 1 then 's ' when 2 then 'E' else 'w' end"
        " as direction_of_travel",
        "case when event_type = 'view' then cast(floor(value) as int)"
        " else cast(event_id % 5 as int) end as pedal_cycles",
        "cast(event_id % 7 as int) as two_wheeled_motor_vehicles",
        "cast(floor(value) as int) + 10 as cars_and_taxis",
        "case when event_type = 'click' then cast(floor(value) as int) else 2 end as buses_and_coaches",
        "cast(user_id % 40 as int) as lgvs",
        "case when event_type = 'error' then null else cast(event_id % 60 as int) end as all_hgvs",
        "cast(floor(value) as int) + 100 as all_motor_vehicles",
    )


def collisions_raw(orders: DataFrame) -> DataFrame:
    """Collisions; one order in ten repeats the id of the next."""
    return orders.selectExpr(
        "cast(case when o_orderkey % 10 = 0 then o_orderkey + 1 else o_orderkey end as string)"
        " as accident_index",
        "date_format(o_orderdate, 'dd/MM/yyyy') as date",
        "case when o_orderkey % 31 = 0 then null else concat(lpad(cast(o_orderkey % 24 as string), 2, '0'),"
        " ':', lpad(cast(o_orderkey % 60 as string), 2, '0')) end as time",
        "(48500 + (o_custkey * 7) % 13000) / 1000.0D as latitude",
        "((o_custkey * 11) % 11000 - 8500) / 1000.0D as longitude",
        "cast(1 + o_orderkey % 3 as int) as number_of_vehicles",
        "cast(1 + o_orderkey % 4 as int) as number_of_casualties",
        "cast(20 + 10 * (o_custkey % 6) as int) as speed_limit",
        "cast(substr(o_orderpriority, 1, 1) as int) as accident_severity",
        "cast(1 + o_orderkey % 2 as int) as urban_or_rural_area",
        "cast(o_orderkey % 8 as int) as light_conditions",
        "cast(o_orderkey % 9 as int) as weather_conditions",
    )


def vehicles_raw(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "cast(l_orderkey as string) as accident_index",
        "l_linenumber as vehicle_reference",
        "case when l_partkey % 97 = 0 then 90 else cast(l_partkey % 25 as int) end as vehicle_type",
        "cast(l_quantity as int) * 2 as age_of_driver",
        "case when l_suppkey % 20 = 19 then null else cast(l_suppkey % 20 as int) end as age_of_vehicle",
        "cast(floor(l_extendedprice) as int) as engine_capacity_cc",
    )


def casualties_raw(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "cast(l_orderkey as string) as accident_index",
        "l_linenumber as casualty_reference",
        "cast(1 + l_suppkey % 4 as int) as casualty_severity",
        "cast(l_quantity as int) * 2 - 1 as age_of_casualty",
        "cast(l_partkey % 25 as int) as casualty_type",
        "cast(1 + l_suppkey % 3 as int) as sex_of_casualty",
    )


def envelopes(events: DataFrame) -> DataFrame:
    """Event envelopes; ``error`` events carry text that is no JSON."""
    base = events.selectExpr(
        "*",
        "date_trunc('hour', ts) as cycle",
        "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k",
        "case event_type when 'view' then 'national_intensity' when 'click' then 'generation_mix'"
        " when 'purchase' then 'regional_intensity' when 'signup' then 'regional_generation' end as kind",
        "make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts),"
        " case when minute(ts) < 30 then 0 else 30 end, 0.0) as since",
    ).selectExpr(
        "*",
        "kind in ('national_intensity', 'regional_intensity') as is_intensity",
        "kind in ('regional_intensity', 'regional_generation') as is_regional",
        "kind <> 'regional_generation' as has_period",
    )
    body = F.expr(
        "struct(kind as event_type,"
        " date_format(cycle, \"yyyy-MM-dd'T'HH:mm:ss\") as timestamp,"
        " case when has_period then date_format(since, \"yyyy-MM-dd'T'HH:mm'Z'\") end as from,"
        " case when has_period then date_format(since + interval 30 minutes, \"yyyy-MM-dd'T'HH:mm'Z'\") end as to,"
        " case when is_intensity then value end as forecast,"
        " case when kind = 'national_intensity' then value + k - 50 end as actual,"
        " case when is_intensity then element_at(array('very low', 'low', 'moderate', 'high', 'very high'),"
        "   k % 5 + 1) end as index,"
        " case when not is_intensity then element_at(array('biomass', 'coal', 'imports', 'gas', 'nuclear',"
        "   'other', 'hydro', 'solar', 'wind'), k % 9 + 1) end as fuel,"
        " case when not is_intensity then k / 10.0D end as percentage,"
        " case when is_regional then cast(1 + user_id % 17 as int) end as region_id,"
        " case when is_regional then concat('Region ', 1 + user_id % 17) end as region_name,"
        " case when kind = 'regional_intensity' then concat('DNO ', 1 + user_id % 17) end as dno_region)"
    )
    return base.select(
        F.when(F.col("kind").isNull(), F.lit('{"oops')).otherwise(F.to_json(body)).alias("raw_json"),
        F.expr("cast(user_id % 2 as string)").alias("partition_id"),
        F.date_format("cycle", "yyyy-MM-dd HH:mm:ss").alias("enqueued_time"),
        F.col("event_id").alias("sequence_number"),
    )


def snapshots(events: DataFrame) -> DataFrame:
    """Nested polls: one per event, with 1..3 regions of 1..4 fuels each."""
    return events.selectExpr(
        "*", "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k"
    ).selectExpr(
        "cast(event_id as string) as polled_at",
        "named_struct('from', 'a', 'to', 'b', 'intensity',"
        " named_struct('forecast', value, 'actual', value + 1, 'index', 'low')) as national",
        "named_struct('from', 'a', 'to', 'b', 'generationmix', transform(sequence(0, k % 9),"
        " f -> named_struct('fuel', concat('f', f), 'perc', (k + f) / 10.0D))) as generation",
        "named_struct('from', 'a', 'to', 'b', 'regions', transform(sequence(1, cast(1 + user_id % 3 as int)),"
        " r -> named_struct('regionid', r, 'shortname', concat('R', r), 'dnoregion', concat('D', r),"
        " 'intensity', named_struct('forecast', value + r, 'index', 'low'),"
        " 'generationmix', transform(sequence(0, k % 4),"
        "  f -> named_struct('fuel', concat('f', f), 'perc', (r + f) / 10.0D))))) as regional",
    )


class Inputs:
    """Silver and gold tables over one data folder, built on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def annual_raw(self):
        return annual_raw(self.table("lineitem"))

    @cached_property
    def annual_points_raw(self):
        return annual_points_raw(self.table("lineitem"))

    @cached_property
    def regions_raw(self):
        return regions_raw(self.table("region"))

    @cached_property
    def authorities_raw(self):
        return authorities_raw(self.table("nation"))

    @cached_property
    def hourly_raw(self):
        return hourly_raw(self.table("events"))

    @cached_property
    def hourly_points_raw(self):
        return hourly_points_raw(self.table("customer"))

    @cached_property
    def collisions_raw(self):
        return collisions_raw(self.table("orders"))

    @cached_property
    def vehicles_raw(self):
        return vehicles_raw(self.table("lineitem"))

    @cached_property
    def casualties_raw(self):
        return casualties_raw(self.table("lineitem"))

    @cached_property
    def envelopes(self):
        return envelopes(self.table("events"))

    @cached_property
    def snapshots(self):
        return snapshots(self.table("events"))

    # silver
    @cached_property
    def annual_counts(self):
        return silver.annual_counts(self.annual_raw)

    @cached_property
    def annual_points(self):
        return silver.annual_count_points(self.annual_points_raw)

    @cached_property
    def regions(self):
        return silver.named_areas(self.regions_raw)

    @cached_property
    def authorities(self):
        return silver.named_areas(self.authorities_raw)

    @cached_property
    def hourly_counts(self):
        return silver.hourly_counts(self.hourly_raw)

    @cached_property
    def hourly_points(self):
        return silver.hourly_count_points(self.hourly_points_raw)

    @cached_property
    def collisions(self):
        return silver.collisions(self.collisions_raw)

    @cached_property
    def vehicles(self):
        return silver.vehicles(self.vehicles_raw)

    @cached_property
    def casualties(self):
        return silver.casualties(self.casualties_raw)

    @cached_property
    def events(self):
        return payload.parsed(self.envelopes)

    @cached_property
    def latest_events(self):
        return carbon.latest_cycle(self.events)

    # gold
    @cached_property
    def summary(self):
        return annual.traffic_summary(self.annual_counts, self.regions)

    @cached_property
    def co2(self):
        return annual.co2_emissions(self.annual_counts, self.regions)

    @cached_property
    def mix(self):
        return annual.vehicle_mix(self.annual_counts, self.regions)

    @cached_property
    def impact(self):
        return annual.covid_impact(self.annual_counts, self.regions, BASE_YEAR, LAST_BASE_YEAR)

    @cached_property
    def daily(self):
        return hourly.daily_traffic(self.hourly_counts)

    @cached_property
    def peaks(self):
        return hourly.hourly_peaks(self.hourly_counts)

    @cached_property
    def point_dim(self):
        return hourly.count_point_dim(self.hourly_points)

    @cached_property
    def accident_summary(self):
        return safety.accident_summary(self.collisions)

    @cached_property
    def hotspots(self):
        return safety.accident_hotspots(self.collisions)

    @cached_property
    def annual_dates(self):
        return dates.date_dim(dates.spine_of(self.annual_counts))

    @cached_property
    def hourly_dates(self):
        return dates.date_dim_fiscal(dates.spine_of(self.hourly_counts))
