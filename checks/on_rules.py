"""Registered queries on silver tables, scalar rules and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import oracle as o
from checks.registry import add, all_of, count_sql, counted, tally, tally_sql
from viagrid.functions import calendar, cleaning, labels, metrics
from viagrid.operators import keyed
from viagrid.plans import annual, hourly, safety, silver

col = F.col

# ============================================================ silver tables
add("SV1_count_points_hourly", lambda i: i.hourly_points, all_of("hourly_points"))
add("SV2_counts_hourly", lambda i: i.hourly_counts, all_of("hourly_counts"))
add(
    "SV3_named_areas",
    lambda i: silver.named_areas(i.authorities_raw, typed_id=False),
    "SELECT CAST(id AS VARCHAR) AS id, name, region_id FROM authorities",
)
add("SV4_collisions", lambda i: i.collisions, all_of("collisions"))
add("SV5_vehicles", lambda i: i.vehicles, all_of("vehicles"))
add("SV6_casualties", lambda i: i.casualties, all_of("casualties"))
add("SV7_counts_annual", lambda i: i.annual_counts, all_of("annual_counts"))
add("SV8_count_points_annual", lambda i: i.annual_points, all_of("annual_points"))
add("SV9_regions", lambda i: i.regions, all_of("regions"))
add("SV9_local_authorities", lambda i: i.authorities, all_of("authorities"))
add("SV10_events", lambda i: i.events, all_of("carbon_events"))

# ============================================================ projections and filters
add(
    "P1_rename_keys",
    lambda i: i.vehicles_raw.withColumnsRenamed(
        {"accident_index": "collision_id", "vehicle_reference": "reference"}
    ).select("collision_id", "reference"),
    "SELECT CAST(l_orderkey AS VARCHAR) AS collision_id, l_linenumber AS reference FROM lineitem",
)
add(
    "P2_typed_casts",
    lambda i: cleaning.conform(i.annual_raw, {**silver.ANNUAL_COUNTS, "latitude": cleaning.real}),
    "SELECT * EXCLUDE (l_partkey, l_linenumber) FROM annual_typed",
)
add(
    "P3_text_rules",
    lambda i: tally(
        i.hourly_points_raw,
        road_name=cleaning.capitals(col("road_name")),
        road_type=cleaning.stripped(col("road_type")),
        region_name=cleaning.title_case(col("region_name")),
        local_authority_name=cleaning.title_case(col("local_authority_name")),
    ),
    count_sql("hourly_points_typed", "road_name", "road_type", "region_name", "local_authority_name"),
)
add(
    "P4_area_bounds",
    lambda i: tally(
        i.hourly_points_raw, latitude=col("latitude"), longitude=col("longitude"),
        inside=cleaning.within_area(),
    ),
    tally_sql("hourly_points_typed", latitude="latitude", longitude="longitude", inside=o.IN_AREA),
)
add(
    "P5_not_null",
    lambda i: counted(
        cleaning.conform(i.annual_raw, {**silver.ANNUAL_COUNTS, "latitude": cleaning.real}).filter(
            cleaning.all_present("latitude", "longitude", "year", "count_point_id")
        ),
        "year",
    ),
    count_sql("annual_typed WHERE latitude IS NOT NULL AND year IS NOT NULL", "year"),
)
add(
    "P6_year_window",
    lambda i: counted(
        i.hourly_raw.filter(cleaning.within_years(2000, 2025)), "year"
    ),
    count_sql("hourly_typed WHERE year BETWEEN 2000 AND 2025", "year"),
)
add(
    "P7_total_vehicles",
    lambda i: tally(i.annual_counts, all_hgvs=col("all_hgvs"), total_vehicles=metrics.total_vehicles()),
    tally_sql("annual_counts", all_hgvs="all_hgvs", total_vehicles=o.SUM_ALL),
)
add(
    "P8_hgv_share_of_total",
    lambda i: counted(i.hourly_counts, "all_hgvs", "total_vehicles", "hgv_percentage"),
    count_sql("hourly_counts", "all_hgvs", "total_vehicles", "hgv_percentage"),
)
add(
    "P8_hgv_share_of_motor",
    lambda i: counted(i.annual_counts, "all_hgvs", "all_motor_vehicles", "hgv_percentage"),
    count_sql("annual_counts", "all_hgvs", "all_motor_vehicles", "hgv_percentage"),
)
add(
    "P9_equality_and_membership",
    lambda i: counted(
        i.hourly_counts.filter(col("time_period").isin(*hourly.TWO_PEAKS) & (col("direction_of_travel") == "N")),
        "year", "time_period",
    ),
    count_sql(
        "hourly_counts WHERE time_period IN ('morning_peak', 'evening_peak') AND direction_of_travel = 'N'",
        "year", "time_period",
    ),
)
add(
    "P10_year_range",
    lambda i: counted(i.annual_counts.filter(col("year").between(1996, 1999)), "year", "region_id"),
    count_sql("annual_counts WHERE year BETWEEN 1996 AND 1999", "year", "region_id"),
)
add(
    "P11_column_subset",
    lambda i: i.hourly_points.select("count_point_id", "region_name", "road_type"),
    "SELECT count_point_id, region_name, road_type FROM hourly_points",
)
add(
    "P12_sums_across",
    lambda i: i.daily.groupBy("year").agg(
        *(F.sum(c).alias(c) for c in ("motorised_vehicles", "freight_vehicles", "active_travel_vehicles"))
    ),
    f"""SELECT year, {o.total('motorised_vehicles')} AS motorised_vehicles,
 {o.total('freight_vehicles')} AS freight_vehicles, {o.total('active_travel_vehicles')} AS active_travel_vehicles
 FROM daily GROUP BY year""",
)

# ============================================================ scalar functions
add(
    "C1_parse_dates",
    lambda i: tally(
        i.collisions_raw, date=col("date"), parsed=cleaning.day("dd/MM/yyyy")(col("date")),
        misread=cleaning.day("yyyy-MM-dd")(col("date")),
    ),
    tally_sql("collisions_typed", date="date", parsed="collision_date", misread="CAST(NULL AS DATE)"),
)
add(
    "C2_date_parts",
    lambda i: tally(
        i.collisions, date=col("collision_date"), year=F.year("collision_date"), month=F.month("collision_date"),
        day=F.dayofmonth("collision_date"), quarter=F.quarter("collision_date"), weekday=F.dayofweek("collision_date"),
    ),
    tally_sql(
        "collisions", date="collision_date", year="year(collision_date)::INTEGER", month="month(collision_date)::INTEGER",
        day="day(collision_date)::INTEGER", quarter="quarter(collision_date)::INTEGER",
        weekday="(dayofweek(collision_date) + 1)::INTEGER",
    ),
)
add(
    "C3_date_names",
    lambda i: tally(
        i.collisions, date=col("collision_date"), day_name=F.date_format("collision_date", "EEEE"),
        month_name=F.date_format("collision_date", "MMMM"),
    ),
    tally_sql(
        "collisions", date="collision_date", day_name="strftime(collision_date, '%A')",
        month_name="strftime(collision_date, '%B')",
    ),
)
add(
    "C4_weekend",
    lambda i: tally(i.collisions, date=col("collision_date"), weekend=calendar.is_weekend(col("collision_date"))),
    tally_sql("collisions", date="collision_date", weekend="dayofweek(collision_date) IN (0, 6)"),
)
add(
    "C5_hour_of_text",
    lambda i: tally(i.collisions_raw, time=col("time"), hour=calendar.clock_hour(col("time"))),
    tally_sql("collisions_typed", time="time", hour="CAST(substr(time, 1, 2) AS INTEGER)"),
)
add("C6_json_to_columns", lambda i: i.events.drop("event_time"), "SELECT * EXCLUDE (event_time) FROM carbon_events")
add(
    "C7_text_to_timestamp",
    lambda i: counted(i.events, "event_time", "data_timestamp"),
    count_sql("carbon_events", "event_time", "data_timestamp"),
)
add(
    "C8_fiscal_periods",
    lambda i: tally(
        i.collisions, date=col("collision_date"), fiscal_year=calendar.fiscal_year(col("collision_date")),
        fiscal_quarter=calendar.fiscal_quarter(col("collision_date")),
    ),
    """SELECT date, fiscal_year, fiscal_quarter, COUNT(*) AS n FROM (SELECT date, """
    + ", ".join(o.FISCAL_COLUMNS.split(",\n", 1)[1:])
    + " FROM (SELECT collision_date AS date FROM collisions)) GROUP BY ALL",
)
add(
    "C9_shares",
    lambda i: i.mix.select("region_name", "year", "car_share_pct", "cycle_share_pct", "hgv_share_pct", "bus_share_pct"),
    "SELECT region_name, year, car_share_pct, cycle_share_pct, hgv_share_pct, bus_share_pct FROM fact_mix_annual",
)
add(
    "C10_green_index",
    lambda i: i.summary.select("region_name", "road_type", "year", "green_transport_index"),
    "SELECT region_name, road_type, year, green_transport_index FROM fact_traffic_summary",
)
add(
    "C11_C12_co2_per_row",
    lambda i: counted(
        annual.with_co2(i.annual_counts), *metrics.VEHICLE_KINDS,
        *(f"co2_{kind}_kg" for kind in metrics.VEHICLE_KINDS), "total_co2_kg",
    ),
    tally_sql(
        "annual_counts", **{kind: kind for kind in o.CO2},
        **{f"co2_{kind}_kg": f"CAST({rule} AS DOUBLE)" for kind, rule in o.CO2.items()},
        total_co2_kg=f"CAST({o.TOTAL_CO2} AS DOUBLE)",
    ),
)
add(
    "C13_vehicles_per_km",
    lambda i: annual.road_analysis(i.annual_counts, i.regions).select(
        "region_name", "road_class", "road_name", "year", "vehicles_per_km"
    ),
    "SELECT region_name, road_class, road_name, year, vehicles_per_km FROM fact_road",
)
add(
    "C14_congestion_index",
    lambda i: counted(i.peaks, "avg_vehicles", "max_vehicles", "congestion_index"),
    count_sql("peaks", "avg_vehicles", "max_vehicles", "congestion_index"),
)
add(
    "C15_ksi_rate",
    lambda i: counted(i.accident_summary, "total_collisions", "ksi_count", "ksi_rate"),
    count_sql("accident_summary", "total_collisions", "ksi_count", "ksi_rate"),
)
add(
    "C16_grid_cells",
    lambda i: tally(
        i.collisions, latitude=col("latitude"), longitude=col("longitude"),
        lat_grid=F.round("latitude", 2), lon_grid=F.round("longitude", 2),
    ),
    tally_sql(
        "collisions", latitude="latitude", longitude="longitude",
        lat_grid=o.rnd("latitude", 2), lon_grid=o.rnd("longitude", 2),
    ),
)
add(
    "C17_severity_score",
    lambda i: counted(i.hotspots, "total_incidents", "fatal_incidents", "serious_incidents", "severity_score"),
    count_sql("hotspots", "total_incidents", "fatal_incidents", "serious_incidents", "severity_score"),
)
add(
    "C18_forecast_variance",
    lambda i: tally(
        i.events, forecast=col("forecast"), actual=col("actual"),
        variance=metrics.change(col("actual"), col("forecast")),
    ),
    tally_sql("carbon_events", forecast="forecast", actual="actual", variance=o.rnd("actual - forecast", 2)),
)
add(
    "C19_cycles_per_point",
    lambda i: hourly.active_travel(i.hourly_counts, i.hourly_points).select(
        "region_name", "local_authority_name", "year", "cycles_per_observation_point"
    ),
    "SELECT region_name, local_authority_name, year, cycles_per_observation_point FROM active_travel",
)

# ============================================================ labels
LABELS = {
    "L1_count_period": ("hourly_counts", "hour", labels.count_period, o.PERIOD),
    "L2_severity_collision": ("collisions", "accident_severity", labels.severity, o.SEVERITY.format(c="accident_severity")),
    "L2_severity_casualty": ("casualties", "casualty_severity", labels.severity, o.SEVERITY.format(c="casualty_severity")),
    "L3_is_urban": ("collisions", "urban_or_rural_area", labels.is_urban, "COALESCE(urban_or_rural_area = 1, FALSE)"),
    "L4_light": ("collisions", "light_conditions", labels.light, o.LIGHT.format(c="light_conditions")),
    "L5_weather": ("collisions", "weather_conditions", labels.weather, o.WEATHER.format(c="weather_conditions")),
    "L6_vehicle_type": ("vehicles", "vehicle_type", labels.vehicle_type, o.VEHICLE.format(c="vehicle_type")),
    "L7_driver_age": ("vehicles", "age_of_driver", labels.driver_age_band, o.DRIVER_AGE.format(c="age_of_driver")),
    "L8_casualty_age": ("casualties", "age_of_casualty", labels.casualty_age_band, o.CASUALTY_AGE.format(c="age_of_casualty")),
    "L9_casualty_type": ("casualties", "casualty_type", labels.casualty_type, o.CASUALTY.format(c="casualty_type")),
    "L10_sex": ("casualties", "sex_of_casualty", labels.sex, o.SEX.format(c="sex_of_casualty")),
    "L11_road_class": ("annual_counts", "road_category", labels.road_class, o.ROAD_CLASS),
    "L12_road_category": ("hourly_points", "road_type", labels.road_category, o.ROAD_CATEGORY),
    "L14_energy": ("events", "fuel_type", labels.energy_category, o.ENERGY),
    "L15_risk": ("hotspots", "hotspot_rank", labels.risk_category, o.RISK),
    "L16_speed_band": ("collisions", "speed_limit", labels.speed_band, o.SPEED),
    "L17_area_type": ("collisions", "is_urban", labels.area_type, o.AREA),
    "L18_emission": ("co2", "co2_per_vehicle_kg", labels.emission_category, o.EMISSION),
    "L19_tier": ("mix", "green_transport_index", labels.sustainability_tier, o.TIER),
    "L20_congestion": ("peaks", "congestion_index", labels.congestion_level, o.CONGESTION),
    "L21_period_order": ("peaks", "time_period", labels.period_sort_order, o.PERIOD_SORT),
    "L13_intensity_national": ("events", "actual", labels.intensity_category, o.INTENSITY.format(c="actual")),
    "L13_intensity_regional": ("events", "forecast", labels.intensity_category, o.INTENSITY.format(c="forecast")),
}
SQL_NAME = {"events": "carbon_events", "co2": "fact_co2_annual", "mix": "fact_mix_annual"}

for key, (table, column, rule, case) in LABELS.items():
    add(
        key,
        lambda i, table=table, column=column, rule=rule: tally(
            getattr(i, table), value=col(column), label=rule(col(column))
        ),
        tally_sql(SQL_NAME.get(table, table), value=column, label=case),
    )
add(
    "L1b_collision_period",
    lambda i: counted(safety.time_patterns(i.collisions), "hour", "time_period"),
    f"""SELECT hour, time_period, COUNT(*) AS n FROM (SELECT DISTINCT collision_year, day_of_week, hour, severity_label,
 {o.COLLISION_PERIOD} AS time_period FROM (SELECT *, CAST(substr(time, 1, 2) AS INTEGER) AS hour FROM collisions))
 GROUP BY ALL""",
)

# ============================================================ set operations
add(
    "U2_latest_per_key",
    lambda i: keyed.one_per_key(i.table("lineitem"), ["l_orderkey"], ["l_shipdate", "l_linenumber"]),
    """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
 ORDER BY l_shipdate DESC NULLS LAST, l_linenumber DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
add(
    "U2_one_per_key",
    lambda i: keyed.one_per_key(i.table("lineitem"), ["l_orderkey", "l_linenumber"]),
    o.deduped(
        "lineitem", "l_orderkey, l_linenumber",
        "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate",
    ),
)
add(
    "U3_distinct_values",
    lambda i: i.annual_counts.select("region_id", "road_type").distinct(),
    "SELECT DISTINCT region_id, road_type FROM annual_counts",
)
