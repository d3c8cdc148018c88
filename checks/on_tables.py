"""Registered queries on joins, gold tables, views, measures and quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import oracle as o
from checks.registry import add, all_of, count_sql, counted, stored
from checks.standins import BASE_YEAR, LAST_BASE_YEAR
from viagrid.functions import cleaning
from viagrid.operators import compare, lookup, quality, ranking
from viagrid.operators.quarantine import Gate
from viagrid.plans import annual, dates, domain, hourly, measures, safety, serving, silver
from viagrid.session import folder_exists, work_folder
from viagrid.sources import catalog

col = F.col

# ============================================================ joins
add(
    "J1_counts_with_region",
    lambda i: counted(lookup.with_region(i.annual_counts, i.regions), "region_name", "year"),
    count_sql("annual_named", "region_name", "year"),
)
add(
    "J2_counts_with_point",
    lambda i: counted(
        lookup.with_point(i.hourly_counts, i.hourly_points, ["region_name", "road_type"]),
        "region_name", "road_type", "year",
    ),
    count_sql("hourly_named", "region_name", "road_type", "year"),
)
add(
    "J3_casualties_with_collision",
    lambda i: safety.casualty_demographics(i.casualties, i.collisions)
    .groupBy("collision_year", "is_urban").agg(F.sum("casualty_count").alias("n")),
    """SELECT c.collision_year, c.is_urban, COUNT(*) AS n FROM casualties k JOIN collisions c
 ON k.collision_id = c.collision_id GROUP BY ALL""",
)
add(
    "J4_vehicles_with_collision",
    lambda i: safety.vehicle_analysis(i.vehicles, i.collisions)
    .groupBy("collision_year", "severity_label").agg(F.sum("vehicle_count").alias("n")),
    """SELECT c.collision_year, c.severity_label, COUNT(*) AS n FROM vehicles v JOIN collisions c
 ON v.collision_id = c.collision_id GROUP BY ALL""",
)
add(
    "J5_counts_with_region_and_authority",
    lambda i: counted(
        lookup.with_authority(lookup.with_region(i.annual_counts, i.regions), i.authorities),
        "region_name", "local_authority_name", "year",
    ),
    """SELECT c.region_name, a.name AS local_authority_name, c.year, COUNT(*) AS n
 FROM annual_named c JOIN authorities a ON c.local_authority_id = a.id GROUP BY ALL""",
)
add(
    "J6_base_period",
    lambda i: i.impact.select("region_name", "road_type", "year", "total_vehicles", "baseline_1996"),
    "SELECT region_name, road_type, year, total_vehicles, baseline_1996 FROM fact_impact",
)
add(
    "J7_daily_with_point_and_date",
    lambda i: counted(
        lookup.with_point(i.daily, i.point_dim, ["region_name"]).join(
            i.hourly_dates.select(col("date").alias("count_date"), "day_name"), "count_date"
        ),
        "region_name", "day_name",
    ),
    """SELECT p.region_name, d.day_name, COUNT(*) AS n FROM daily f JOIN point_dim p
 ON f.count_point_id = p.count_point_id JOIN hourly_dates d ON f.count_date = d.date GROUP BY ALL""",
)
VIEW_SQL = """SELECT d.year, d.month, d.month_name, d.quarter, d.fiscal_year, d.day_name, d.is_weekend,
 p.region_name, p.local_authority_name, p.road_name, p.road_type, p.road_category, p.latitude, p.longitude,
 f.total_all_vehicles, f.total_cars, f.total_hgvs, f.total_buses, f.total_lgvs, f.total_pedal_cycles,
 f.total_motorcycles, f.motorised_vehicles, f.freight_vehicles, f.active_travel_vehicles, f.avg_hgv_percentage,
 f.hours_counted, y.yoy_change_pct, y.total_vehicles AS annual_total_vehicles
 FROM daily f JOIN point_dim p ON f.count_point_id = p.count_point_id JOIN hourly_dates d ON f.count_date = d.date
 LEFT JOIN yoy y ON p.region_name = y.region_name AND p.road_type = y.road_type AND d.year = y.year"""


def traffic_view(i):
    yoy = hourly.yoy_regional(i.hourly_counts, i.hourly_points)
    return serving.traffic_summary(i.daily, i.point_dim, i.hourly_dates, yoy)


add(
    "J8_daily_with_growth",
    lambda i: traffic_view(i).groupBy("region_name", "road_type", "year").agg(
        F.max("yoy_change_pct").alias("yoy_change_pct"), F.max("annual_total_vehicles").alias("annual_total_vehicles")
    ),
    f"""SELECT region_name, road_type, year, MAX(yoy_change_pct) AS yoy_change_pct,
 MAX(annual_total_vehicles) AS annual_total_vehicles FROM ({VIEW_SQL}) GROUP BY ALL""",
)
add(
    "J9_peaks_with_point",
    lambda i: counted(
        lookup.with_point(i.peaks, i.point_dim, ["region_name", "road_category"]), "region_name", "road_category", "hour"
    ),
    """SELECT p.region_name, p.road_category, h.hour, COUNT(*) AS n FROM peaks h JOIN point_dim p
 ON h.count_point_id = p.count_point_id GROUP BY ALL""",
)
add(
    "J10_date_slicer",
    lambda i: lookup.in_dates(i.summary, i.annual_dates.filter(col("quarter") * 1 == col("year") % 4)),
    """SELECT * FROM fact_traffic_summary WHERE year IN
 (SELECT year FROM annual_dates WHERE quarter = year % 4)""",
)

# ============================================================ gold facts
add("A1_fact_daily_traffic", lambda i: i.daily, all_of("daily"))
add("A2_fact_hourly_peaks", lambda i: i.peaks, all_of("peaks"))
add("A3_fact_yoy_regional", lambda i: hourly.yoy_regional(i.hourly_counts, i.hourly_points), all_of("yoy"))
add(
    "A4_fact_co2_emissions_hourly",
    lambda i: hourly.co2_emissions(i.hourly_counts, i.hourly_points), all_of("fact_co2_hourly"),
)
add(
    "A4_fact_co2_emissions_in_tonnes",
    lambda i: hourly.co2_emissions(i.hourly_counts, i.hourly_points, heavy_in_tonnes=True).select(
        "region_name", "local_authority_name", "road_type", "year", "bus_co2_tonnes", "lgv_co2_tonnes"
    ),
    f"""SELECT region_name, local_authority_name, road_type, year,
 {o.co2_tonnes(o.CO2['buses_and_coaches'])} AS bus_co2_tonnes, {o.co2_tonnes(o.CO2['lgvs'])} AS lgv_co2_tonnes
 FROM hourly_named GROUP BY ALL""",
)
add(
    "A5_fact_vehicle_mix_hourly",
    lambda i: hourly.vehicle_mix(i.hourly_counts, i.hourly_points), all_of("fact_mix_hourly"),
)
add(
    "A6_fact_active_travel",
    lambda i: hourly.active_travel(i.hourly_counts, i.hourly_points), all_of("active_travel"),
)
add("A7_fact_accident_summary", lambda i: i.accident_summary, all_of("accident_summary"))
add("A8_fact_accident_hotspots", lambda i: i.hotspots, all_of("hotspots"))
CASUALTY_SQL = """SELECT c.collision_year, k.casualty_severity_label, k.casualty_type_label, k.casualty_age_band, k.sex_label,
 c.is_urban, COUNT(*) AS casualty_count FROM casualties k JOIN collisions c ON k.collision_id = c.collision_id GROUP BY ALL"""
add(
    "A9_fact_casualty_demographics",
    lambda i: safety.casualty_demographics(i.casualties, i.collisions), CASUALTY_SQL,
)
add(
    "A10_fact_vehicle_analysis",
    lambda i: safety.vehicle_analysis(i.vehicles, i.collisions),
    """SELECT c.collision_year, v.vehicle_type_label, v.driver_age_band, c.severity_label, COUNT(*) AS vehicle_count,
 AVG(v.age_of_vehicle) AS avg_vehicle_age, AVG(v.engine_capacity_cc) AS avg_engine_cc
 FROM vehicles v JOIN collisions c ON v.collision_id = c.collision_id GROUP BY ALL""",
)
add(
    "A11_fact_time_patterns",
    lambda i: safety.time_patterns(i.collisions),
    f"""SELECT collision_year, day_of_week, hour, {o.COLLISION_PERIOD} AS time_period, severity_label,
 COUNT(*) AS collision_count, {o.total('number_of_casualties')} AS casualty_count
 FROM (SELECT *, CAST(substr(time, 1, 2) AS INTEGER) AS hour FROM collisions) GROUP BY ALL""",
)
add("A12_fact_traffic_summary", lambda i: i.summary, all_of("fact_traffic_summary"))
add("A13_fact_co2_emissions_annual", lambda i: i.co2, all_of("fact_co2_annual"))
add("A14_fact_vehicle_mix_annual", lambda i: i.mix, all_of("fact_mix_annual"))
add("A15_fact_road_analysis", lambda i: annual.road_analysis(i.annual_counts, i.regions), all_of("fact_road"))
add("A16_fact_covid_impact", lambda i: i.impact, all_of("fact_impact"))


def stored_table(i, label: str, df):
    """A table written and read back, so that what reads it twice does not compute it twice."""
    return i.spark.read.parquet(stored(i, label, df))


def busiest_sql(year: str) -> str:
    return f"""SELECT * FROM (SELECT *, CAST(DENSE_RANK() OVER (ORDER BY total_vehicles DESC) AS INTEGER) AS rank FROM (
 SELECT region_name, road_name, road_type, latitude, longitude, {o.total('all_motor_vehicles')} AS total_vehicles,
 {o.total('all_hgvs')} AS total_hgvs, {o.total('pedal_cycles')} AS total_cycles FROM annual_named
 WHERE year = {year} GROUP BY ALL)) WHERE rank <= 500"""


LATEST_SQL = "(SELECT MAX(year) FROM annual_counts)"
add(
    "A17_fact_busiest_roads_latest",
    lambda i: annual.busiest_from(stored_table(i, "A17", annual.road_totals(i.annual_counts, i.regions))),
    busiest_sql(LATEST_SQL),
)
add(
    "A17_fact_busiest_roads_of_year",
    lambda i: annual.busiest_from(stored_table(i, "A17", annual.road_totals(i.annual_counts, i.regions, 1999))),
    busiest_sql("1999"),
)
add(
    "A18_year_range",
    lambda i: i.annual_counts.agg(F.min("year").alias("first_year"), F.max("year").alias("last_year")),
    "SELECT MIN(year) AS first_year, MAX(year) AS last_year FROM annual_counts",
)
add(
    "A18_latest_year_filter",
    lambda i: counted(i.annual_counts.filter(col("year") == annual.latest_year(i.annual_counts)), "year", "region_id"),
    count_sql(f"annual_counts WHERE year = {LATEST_SQL}", "year", "region_id"),
)
add(
    "A19_distinct_coverage",
    lambda i: i.annual_counts.agg(
        F.count_distinct("region_id").alias("regions"), F.count_distinct("count_point_id").alias("points"),
        F.count_distinct("year").alias("years"),
    ),
    """SELECT COUNT(DISTINCT region_id) AS regions, COUNT(DISTINCT count_point_id) AS points,
 COUNT(DISTINCT year) AS years FROM annual_counts""",
)
add("A20_rows_per_event_type", lambda i: counted(i.events, "event_type"), count_sql("carbon_events", "event_type"))
add("A21_V7_capacity_utilisation", lambda i: hourly.capacity_utilisation(i.peaks, i.point_dim), all_of("capacity"))



def domain_raw(i) -> dict:
    return {
        "count_points": i.hourly_points_raw, "counts": i.hourly_raw, "regions": i.regions_raw,
        "local_authorities": i.authorities_raw, "collisions": i.collisions_raw,
        "vehicles": i.vehicles_raw, "casualties": i.casualties_raw,
    }


def domain_gold(i, table: str):
    """A gold table of a whole run over hourly counts and collisions, read back."""
    paths = domain.run(i.spark, domain_raw(i), work_folder(i.spark, "domain"), dates.spine_of)
    return i.spark.read.parquet(paths[table])


def gated_run(i, table: str) -> DataFrame:
    """Rows of a silver table by the rules they break ('' for those that stay), after a run under a gate that takes any share."""
    base = work_folder(i.spark, "gated")
    domain.run(i.spark, domain_raw(i), base, dates.spine_of(i.hourly_counts), Gate(most=1.0, last_year=2020))
    stays = i.spark.read.parquet(f"{base}/silver/{table}").select(F.lit("").alias("rules"))
    if not folder_exists(i.spark, f"{base}/quarantine/{table}"):
        return counted(stays, "rules")
    goes = i.spark.read.parquet(f"{base}/quarantine/{table}").select(F.array_join("broken_rules", ",").alias("rules"))
    return counted(stays.union(goes), "rules")


def broken_sql(source: str, rules: dict[str, str]) -> str:
    named = ", ".join(f"CASE WHEN {test} THEN '{rule}' END" for rule, test in rules.items())
    return f"SELECT rules, COUNT(*) AS n FROM (SELECT array_to_string(list_filter([{named}], lambda r: r IS NOT NULL), ',') AS rules FROM {source}) GROUP BY rules"


add(
    "Q_gate_collisions", lambda i: gated_run(i, "collisions"),
    broken_sql("collisions", {
        "null:collision_id": "collision_id IS NULL", "null:latitude": "latitude IS NULL", "null:longitude": "longitude IS NULL",
        "inside_area": f"NOT ({o.IN_AREA})", "member:severity_label": "severity_label NOT IN ('Fatal', 'Serious', 'Slight')",
        "member:speed_limit": "speed_limit NOT IN (20, 30, 40, 50, 60, 70)",
        "positive:number_of_casualties": "number_of_casualties <= 0", "no_future:collision_date": "collision_date > current_date",
    }),
)


add("A4_domain_run_co2", lambda i: domain_gold(i, "fact_co2_emissions"), all_of("fact_co2_hourly"))
add("A9_domain_run_casualties", lambda i: domain_gold(i, "fact_casualty_demographics"), CASUALTY_SQL)

def in_buckets(i) -> dict:
    """The tables of ``safety.by_collision``, stored in buckets."""
    base = work_folder(i.spark, "buckets")
    schema = f"viagrid_{base.rsplit('-', 1)[1][:12]}"
    catalog.create_schema(i.spark, schema, base)
    return domain.store_by_collision(i.spark, {"vehicles": i.vehicles, "casualties": i.casualties, "collisions": i.collisions}, schema, f"{base}/bucketed", 8)


add("J3_bucketed_casualties", lambda i: safety.demographics_from((t := in_buckets(i))["collision_casualties"], t["collision_keys"]), CASUALTY_SQL)
add(
    "J4_bucketed_vehicles",
    lambda i: safety.analysis_from((t := in_buckets(i))["collision_vehicles"], t["collision_keys"])
    .select("collision_year", "vehicle_type_label", "driver_age_band", "severity_label", "vehicle_count"),
    """SELECT c.collision_year, v.vehicle_type_label, v.driver_age_band, c.severity_label, COUNT(*) AS vehicle_count
 FROM vehicles v JOIN collisions c ON v.collision_id = c.collision_id GROUP BY ALL""",
)

THREE_YEARS = (1996, 1997, 1999)


def sliced_points(i, by=()) -> DataFrame:
    """Distinct count points over three years, from stored bitmaps."""
    path = stored(i, "M9", annual.point_bitmaps(i.annual_counts, i.regions), ["year"])
    return measures.points_observed(measures.slice_by(i.spark.read.parquet(path), THREE_YEARS), by)


add(
    "M9_points_over_years", sliced_points,
    f"SELECT COUNT(DISTINCT count_point_id) AS count_points_observed FROM annual_named WHERE year IN {THREE_YEARS}",
)
add(
    "M9_points_over_years_by_region", lambda i: sliced_points(i, ["region_name"]),
    f"SELECT region_name, COUNT(DISTINCT count_point_id) AS count_points_observed FROM annual_named WHERE year IN {THREE_YEARS} GROUP BY region_name",
)

# ============================================================ dimensions
add("D1_dim_date", lambda i: i.annual_dates, all_of("annual_dates"))
add(
    "D1_dim_date_from_year",
    lambda i: dates.date_dim(dates.spine_of(i.annual_counts, 1990)),
    f"""SELECT {o.DATE_COLUMNS} FROM (SELECT CAST(unnest(generate_series(DATE '1990-01-01', make_date(b, 12, 31),
 INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT MAX(year) AS b FROM annual_counts))""",
)
add("D2_dim_date_fiscal", lambda i: i.hourly_dates, all_of("hourly_dates"))
add("D3_dim_location", lambda i: annual.location(i.annual_counts, i.regions, i.authorities), all_of("location"))
add("D4_dim_count_point", lambda i: i.point_dim, all_of("point_dim"))

# ============================================================ windows
add(
    "W1_growth_annual",
    lambda i: i.summary.select("region_name", "road_type", "year", "prev_year_vehicles", "yoy_change_pct"),
    "SELECT region_name, road_type, year, prev_year_vehicles, yoy_change_pct FROM fact_traffic_summary",
)
add(
    "W1_growth_strict",
    lambda i: compare.with_growth(
        i.summary.filter(col("year") != 1998).select("region_name", "road_type", "year", "total_all_vehicles"),
        "total_all_vehicles", annual.GROUP, "before", "growth", strict=True,
    ),
    f"""SELECT a.region_name, a.road_type, a.year, a.total_all_vehicles, b.total_all_vehicles AS before,
 {o.growth('a.total_all_vehicles', 'b.total_all_vehicles')} AS growth
 FROM (SELECT * FROM fact_traffic_summary WHERE year <> 1998) a
 LEFT JOIN (SELECT * FROM fact_traffic_summary WHERE year <> 1998) b
 ON a.region_name = b.region_name AND a.road_type = b.road_type AND b.year = a.year - 1""",
)
add(
    "W2_green_index_change",
    lambda i: i.mix.select("region_name", "year", "prev_green_index", "green_index_change"),
    "SELECT region_name, year, prev_green_index, green_index_change FROM fact_mix_annual",
)
add(
    "W3_cycle_share_change",
    lambda i: hourly.active_travel(i.hourly_counts, i.hourly_points).select(
        "region_name", "local_authority_name", "year", "prev_cycle_share", "cycle_share_change"
    ),
    "SELECT region_name, local_authority_name, year, prev_cycle_share, cycle_share_change FROM active_travel",
)
add(
    "W4_absolute_change",
    lambda i: i.impact.select("region_name", "road_type", "year", "yoy_change"),
    "SELECT region_name, road_type, year, yoy_change FROM fact_impact",
)
add(
    "W5_rank_within_year",
    lambda i: i.hotspots.select("lat_grid", "lon_grid", "collision_year", "severity_score", "hotspot_rank"),
    "SELECT lat_grid, lon_grid, collision_year, severity_score, hotspot_rank FROM hotspots",
)
add(
    "W6_top_ranks_with_ties",
    lambda i: ranking.dense_top(i.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 3),
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_quantity,
 CAST(DENSE_RANK() OVER (ORDER BY l_quantity DESC) AS INTEGER) AS rank FROM lineitem) WHERE rank <= 3""",
)

# ============================================================ sorts and limits
add(
    "O1_top_regions_by_volume",
    lambda i: measures.top_regions_by_volume(i.summary, annual.latest_year(i.annual_counts)),
    f"""SELECT region_name, road_type, year, total_all_vehicles, yoy_change_pct FROM fact_traffic_summary
 WHERE year = {LATEST_SQL} ORDER BY total_all_vehicles DESC, region_name, road_type LIMIT 5""",
)
add(
    "O4_first_rows_by_region_and_year",
    lambda i: ranking.top_rows(
        i.summary.select("year", "region_name", "road_type", "total_all_vehicles"), 5, "region_name", "year", "road_type"
    ),
    """SELECT year, region_name, road_type, total_all_vehicles FROM fact_traffic_summary
 ORDER BY region_name, year, road_type LIMIT 5""",
)
add(
    "O6_sorted_years",
    lambda i: i.annual_counts.select("year").distinct().orderBy("year"),
    "SELECT DISTINCT year FROM annual_counts ORDER BY year",
)

# ============================================================ serving views
add("V1_traffic_summary_view", traffic_view, VIEW_SQL)
add(
    "V2_accident_hotspots_view",
    lambda i: serving.publish(serving.accident_hotspots(i.hotspots), "vw_accident_hotspots"),
    f"SELECT *, {o.RISK} AS risk_category FROM hotspots",
)
add(
    "V3_accident_trends_view",
    lambda i: serving.publish(serving.accident_trends(i.accident_summary), "vw_accident_trends"),
    f"""SELECT collision_year, collision_month, severity_label, weather_label, light_condition_label, is_urban, speed_limit,
 total_collisions, total_casualties, fatal_count, serious_count, slight_count, ksi_count, ksi_rate,
 {o.SPEED} AS speed_band, {o.AREA} AS area_type FROM accident_summary""",
)
add(
    "V4_co2_emissions_view",
    lambda i: serving.co2_emissions(hourly.co2_emissions(i.hourly_counts, i.hourly_points)),
    f"SELECT *, {o.EMISSION} AS emission_category FROM fact_co2_hourly",
)
add(
    "V5_green_transport_view",
    lambda i: serving.green_transport(hourly.vehicle_mix(i.hourly_counts, i.hourly_points)),
    f"SELECT * EXCLUDE (prev_green_index), {o.TIER} AS sustainability_tier FROM fact_mix_hourly",
)
add(
    "V6_congestion_analysis_view",
    lambda i: serving.congestion_analysis(i.peaks, i.point_dim),
    f"""SELECT h.* EXCLUDE (count_point_id), p.* EXCLUDE (count_point_id), {o.CONGESTION} AS congestion_level,
 {o.PERIOD_SORT} AS time_period_sort_order FROM peaks h JOIN point_dim p ON h.count_point_id = p.count_point_id""",
)

# ============================================================ measures
add(
    "M1_total_traffic", lambda i: measures.total_traffic(i.summary),
    f"SELECT {o.total('total_all_vehicles')} AS total_traffic FROM fact_traffic_summary",
)
add(
    "M2_yoy_change", lambda i: measures.yoy_change(i.summary),
    f"SELECT {o.mean2('yoy_change_pct')} AS yoy_change_pct FROM fact_traffic_summary",
)
add(
    "M3_ksi_rate", lambda i: measures.ksi_rate(i.accident_summary),
    "SELECT SUM(ksi_count) / SUM(total_collisions) * 100 AS ksi_rate FROM accident_summary",
)
add(
    "M4_green_index_of_sums", lambda i: measures.green_index_of_sums(i.mix),
    "SELECT SUM(cycles + buses) / SUM(total) * 100 AS green_index FROM fact_mix_annual",
)
add(
    "M5_green_index_mean", lambda i: measures.green_index_mean(i.mix),
    f"SELECT {o.mean2('green_transport_index')} AS green_index FROM fact_mix_annual",
)
add(
    "M6_co2_per_vehicle_of_sums", lambda i: measures.co2_per_vehicle_of_sums(i.co2),
    f"""SELECT {o.units_sum('total_co2_tonnes', 2)} * 1000 / SUM(total_vehicle_count) AS co2_per_vehicle
 FROM fact_co2_annual""",
)
add(
    "M6_co2_per_vehicle_mean", lambda i: measures.co2_per_vehicle_mean(i.co2),
    f"SELECT {o.mean2('co2_per_vehicle_kg')} AS co2_per_vehicle FROM fact_co2_annual",
)
add(
    "M7_recovery", lambda i: measures.recovery(i.impact),
    f"SELECT {o.mean2('recovery_pct')} AS recovery_pct FROM fact_impact",
)
add(
    "M8_total_co2", lambda i: measures.total_co2(i.co2),
    f"SELECT {o.units_sum('total_co2_tonnes', 2)} AS total_co2_tonnes FROM fact_co2_annual",
)
add(
    "M9_slicers",
    lambda i: measures.total_traffic(measures.slice_by(i.summary, [1997, 1999], ["Asia", "Europe"])),
    f"""SELECT {o.total('total_all_vehicles')} AS total_traffic FROM fact_traffic_summary
 WHERE year IN (1997, 1999) AND region_name IN ('Asia', 'Europe')""",
)
add(
    "M10_trend_by_region", lambda i: measures.trend_by_region(i.mix),
    f"SELECT year, region_name, {o.total('total')} AS total FROM fact_mix_annual GROUP BY ALL",
)
add(
    "M11_type_breakdown", lambda i: measures.type_breakdown(i.mix),
    f"""SELECT vehicle_type, vehicles, {o.pct('vehicles', 'shown')} AS share_pct FROM (
 SELECT *, CAST(SUM(vehicles) OVER () AS BIGINT) AS shown FROM (UNPIVOT (SELECT {o.total('cars')} AS cars,
 {o.total('hgvs')} AS hgvs, {o.total('lgvs')} AS lgvs, {o.total('buses')} AS buses, {o.total('cycles')} AS cycles
 FROM fact_mix_annual) ON cars, hgvs, lgvs, buses, cycles INTO NAME vehicle_type VALUE vehicles))""",
)
add(
    "M12_co2_by_region", lambda i: measures.co2_by_region(i.co2),
    f"""SELECT region_name, {o.units_sum('total_co2_tonnes', 2)} AS total_co2_tonnes FROM fact_co2_annual
 GROUP BY region_name ORDER BY 2 DESC, 1""",
)
add(
    "M13_green_index_trend", lambda i: measures.green_index_trend(i.mix),
    f"SELECT year, region_name, {o.mean2('green_transport_index')} AS green_transport_index FROM fact_mix_annual GROUP BY ALL",
)
add(
    "M14_weather_by_severity", lambda i: measures.weather_by_severity(i.accident_summary),
    f"""SELECT weather_label, severity_label, {o.total('total_collisions')} AS total_collisions,
 {o.total('total_casualties')} AS total_casualties FROM accident_summary GROUP BY ALL""",
)
add(
    "M14_peak_split", lambda i: measures.peak_split(i.peaks),
    f"""SELECT CASE WHEN time_period IN ('morning_peak', 'evening_peak') THEN 'peak' ELSE 'off_peak' END AS period,
 {o.total('observation_count')} AS observations, MAX(max_vehicles) AS max_vehicles,
 {o.mean2('congestion_index', 3)} AS avg_congestion_index FROM peaks GROUP BY 1""",
)
add(
    "M14_congestion_heat_map", lambda i: measures.congestion_heat_map(i.peaks),
    "SELECT count_point_id, "
    + ", ".join(f"MAX(congestion_index) FILTER (hour = {h}) AS h{h:02d}" for h in measures.HOURS)
    + " FROM peaks GROUP BY count_point_id",
)

# ============================================================ quality rules


def rules_sql(table: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, COUNT(*) FILTER ({test}) AS violations, COUNT(*) AS total"
        f" FROM {source}"
        for rule, test in rules.items()
    )


def rows_rule(key, get, table, source, rules, tests):
    add(
        key, lambda i: quality.check_rows(get(i), table, rules()), rules_sql(table, source, tests)
    )


def typed_annual(i):
    """Typed but unfiltered counts, with missing coordinates as NULL."""
    return cleaning.conform(
        i.annual_raw, {**silver.ANNUAL_COUNTS, "latitude": cleaning.real, "longitude": cleaning.real}
    )


FIRST_FIVE = ("collision_id", "date", "time", "latitude", "longitude")
add(
    "Q1_null_counts_of_five", lambda i: quality.null_counts(i.collisions, "collisions", FIRST_FIVE),
    rules_sql("collisions", "collisions", {f"null:{c}": f"{c} IS NULL" for c in FIRST_FIVE}),
)
VEHICLE_COLUMNS = (
    "collision_id", "vehicle_reference", "vehicle_type", "age_of_driver", "age_of_vehicle", "engine_capacity_cc",
    "vehicle_type_label", "driver_age_band",
)
add(
    "Q1_null_counts", lambda i: quality.null_counts(i.vehicles, "vehicles"),
    rules_sql("vehicles", "vehicles", {f"null:{c}": f"{c} IS NULL" for c in VEHICLE_COLUMNS}),
)
rows_rule(
    "Q2_keys_and_coordinates_present", typed_annual, "counts", "annual_typed",
    lambda: {f"null:{c}": quality.absent(c) for c in ("count_point_id", "latitude", "longitude")},
    {f"null:{c}": f"{c} IS NULL" for c in ("count_point_id", "latitude", "longitude")},
)
rows_rule(
    "Q3_inside_area", typed_annual, "counts", "annual_typed",
    lambda: {"inside_area": quality.out_of_area()}, {"inside_area": f"NOT ({o.IN_AREA})"},
)
rows_rule(
    "Q4_year_range", lambda i: i.hourly_raw, "counts", "hourly_typed",
    lambda: {"year_range": quality.out_of_range("year", 2000, 2025)},
    {"year_range": "year NOT BETWEEN 2000 AND 2025"},
)
rows_rule(
    "Q5_not_negative", lambda i: i.annual_counts, "counts", "annual_counts",
    lambda: {c: quality.negative(c) for c in ("cars_and_taxis", "all_hgvs", "longitude")},
    {c: f"{c} < 0" for c in ("cars_and_taxis", "all_hgvs", "longitude")},
)
rows_rule(
    "Q6_total_covers_parts", lambda i: i.annual_counts, "counts", "annual_counts",
    lambda: {
        "total": quality.below_sum("total_vehicles", ["cars_and_taxis", "all_hgvs", "pedal_cycles"]),
        "motor": quality.below_sum("all_motor_vehicles", ["cars_and_taxis", "all_hgvs", "lgvs", "pedal_cycles"]),
    },
    {
        "total": "total_vehicles < CAST(cars_and_taxis AS BIGINT) + all_hgvs + pedal_cycles",
        "motor": "all_motor_vehicles < CAST(cars_and_taxis AS BIGINT) + all_hgvs + lgvs + pedal_cycles",
    },
)


def unique_sql(table: str, source: str, keys: str) -> str:
    return (
        f"SELECT 'unique:{keys}' AS rule, '{table}' AS table_name, COUNT(*) FILTER (n > 1) AS violations,"
        f" COUNT(*) AS total FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {keys})"
    )


for key, table, get, source, keys in (
    ("Q7_unique_raw_collisions", "collisions", lambda i: i.collisions_raw.withColumnRenamed("accident_index", "collision_id"),
     "collisions_typed", ["collision_id"]),
    ("Q7_unique_collisions", "collisions", lambda i: i.collisions, "collisions", ["collision_id"]),
    ("Q7_unique_point_days", "counts", lambda i: i.hourly_counts, "hourly_counts", ["count_point_id", "year", "count_date"]),
    ("Q7_unique_gold", "fact_traffic_summary", lambda i: i.summary, "fact_traffic_summary", ["region_name", "road_type", "year"]),
):
    add(
        key, lambda i, get=get, table=table, keys=keys: quality.check_unique(get(i), table, keys),
        unique_sql(table, source, ",".join(keys)),
    )
rows_rule(
    "Q8_names_not_blank", lambda i: i.hourly_points, "count_points", "hourly_points",
    lambda: {c: quality.blank(c) for c in ("region_name", "road_name")},
    {c: f"trim({c}) = ''" for c in ("region_name", "road_name")},
)
rows_rule(
    "Q9_members_collisions", lambda i: i.collisions, "collisions", "collisions",
    lambda: {
        "severity": quality.not_member("severity_label", quality.SEVERITIES),
        "speed": quality.not_member("speed_limit", quality.SPEED_LIMITS),
    },
    {
        "severity": "severity_label NOT IN ('Fatal', 'Serious', 'Slight')",
        "speed": "speed_limit NOT IN (20, 30, 40, 50, 60, 70)",
    },
)
rows_rule(
    "Q9_members_fuels", lambda i: i.events, "events", "carbon_events",
    lambda: {"fuel": quality.not_member("fuel_type", ("wind", "solar"))},
    {"fuel": "fuel_type NOT IN ('wind', 'solar')"},
)
rows_rule(
    "Q10_casualties_positive", lambda i: i.collisions, "collisions", "collisions",
    lambda: {"casualties": quality.not_positive("number_of_casualties")}, {"casualties": "number_of_casualties <= 0"},
)
rows_rule(
    "Q11_no_future_dates", lambda i: i.collisions, "collisions", "collisions",
    lambda: {"future": quality.in_future("collision_date")}, {"future": "collision_date > current_date"},
)


def coverage_sql(table: str, source: str, key: str, expected: str, size: int) -> str:
    return (
        f"SELECT 'coverage:{key}' AS rule, '{table}' AS table_name, COUNT(*) AS violations, CAST({size} AS BIGINT) AS total"
        f" FROM (SELECT unnest({expected}) AS e) WHERE e NOT IN (SELECT {key} FROM {source} WHERE {key} IS NOT NULL)"
    )


add(
    "Q12_region_coverage",
    lambda i: quality.check_coverage(i.summary, "fact_traffic_summary", "region_name", quality.REGION_NAMES),
    coverage_sql("fact_traffic_summary", "fact_traffic_summary", "region_name", f"{list(quality.REGION_NAMES)}", 11),
)
add(
    "Q12_year_coverage",
    lambda i: quality.check_coverage(i.annual_counts, "counts", "year", range(1993, 2002)),
    coverage_sql("counts", "annual_counts", "year", "range(1993, 2002)", 9),
)
add(
    "Q12_energy_region_coverage",
    lambda i: quality.check_coverage(i.events, "events", "region_id", quality.ENERGY_REGION_IDS),
    coverage_sql("events", "carbon_events", "region_id", "range(1, 18)", 17),
)
add(
    "Q12_missing_years",
    lambda i: quality.missing_members(i.annual_counts, "year", list(range(1990, 2004))),
    "SELECT CAST(e AS INTEGER) AS year FROM (SELECT unnest(range(1990, 2004)) AS e) WHERE e NOT IN (SELECT year FROM annual_counts)",
)
add(
    "Q13_no_paging_columns",
    lambda i: quality.check_columns(i.annual_raw, "counts", forbidden=quality.PAGING_COLUMNS),
    """SELECT 'forbidden:current_page,last_page,total,per_page' AS rule, 'counts' AS table_name, 0::BIGINT AS violations,
 COUNT(*) AS total FROM lineitem""",
)
add(
    "Q14_required_columns",
    lambda i: quality.check_columns(i.mix, "fact_vehicle_mix", required=["region_name", "year", "not_there"]),
    """SELECT 'required:region_name,year,not_there' AS rule, 'fact_vehicle_mix' AS table_name, 1::BIGINT AS violations,
 COUNT(*) AS total FROM fact_mix_annual""",
)
rows_rule(
    "Q15_co2_per_vehicle", lambda i: i.co2, "fact_co2_emissions", "fact_co2_annual",
    lambda: {"co2_1_5": quality.out_of_range("co2_per_vehicle_kg", 1, 5)},
    {"co2_1_5": "co2_per_vehicle_kg NOT BETWEEN 1 AND 5"},
)
add(
    "Q16_shares_sum_to_100",
    lambda i: quality.check_shares(
        i.events.filter(col("event_type") == "generation_mix"), "events", ["period_from"], "fuel_percentage"
    ),
    f"""SELECT 'sums_to_100:fuel_percentage' AS rule, 'events' AS table_name,
 COUNT(*) FILTER (s NOT BETWEEN 99 AND 101) AS violations, COUNT(*) AS total FROM (
 SELECT {o.units_sum('fuel_percentage', 6)} AS s FROM carbon_events WHERE event_type = 'generation_mix' GROUP BY period_from)""",
)
add(
    "Q17_event_fields",
    lambda i: quality.check_event_fields(i.events, "events"),
    rules_sql("events", "carbon_events", {
        "fields:national_intensity": "event_type = 'national_intensity' AND (forecast IS NULL OR actual IS NULL)",
        "fields:generation_mix": "event_type = 'generation_mix' AND (fuel_type IS NULL OR fuel_percentage IS NULL)",
        "fields:regional_intensity": "event_type = 'regional_intensity' AND (forecast IS NULL OR region_id IS NULL)",
        "fields:regional_generation": "event_type = 'regional_generation' AND (fuel_type IS NULL OR region_id IS NULL)",
        "percentage_0_100": "fuel_percentage NOT BETWEEN 0 AND 100",
        "region_id_from_1": "region_id < 1",
    }),
)
add(
    "Q18_events_per_cycle",
    lambda i: quality.check_cycle_size(i.events, "events", "data_timestamp"),
    """SELECT 'events_per_cycle:180' AS rule, 'events' AS table_name, COUNT(*) FILTER (n <> 180) AS violations,
 COUNT(*) AS total FROM (SELECT COUNT(*) AS n FROM carbon_events GROUP BY data_timestamp)""",
)
rows_rule(
    "Q19_base_present_and_positive", lambda i: i.impact, "fact_covid_impact", "fact_impact",
    lambda: {"null": quality.absent("baseline_1996"), "not_positive": quality.not_positive("baseline_1996")},
    {"null": "baseline_1996 IS NULL", "not_positive": "baseline_1996 <= 0"},
)


# ============================================================ rules by table
add(
    "Q_suite_collisions", lambda i: quality.suite(i.collisions, "collisions"),
    rules_sql("collisions", "collisions", {
        "null:collision_id": "collision_id IS NULL", "null:latitude": "latitude IS NULL", "null:longitude": "longitude IS NULL",
        "inside_area": f"NOT ({o.IN_AREA})", "member:severity_label": "severity_label NOT IN ('Fatal', 'Serious', 'Slight')",
        "member:speed_limit": "speed_limit NOT IN (20, 30, 40, 50, 60, 70)",
        "positive:number_of_casualties": "number_of_casualties <= 0", "no_future:collision_date": "collision_date > current_date",
    }) + " UNION ALL " + unique_sql("collisions", "collisions", "collision_id"),
)
add(
    "Q_suite_casualties", lambda i: quality.suite(i.casualties, "casualties"),
    rules_sql("casualties", "casualties", {
        "null:collision_id": "collision_id IS NULL", "null:casualty_reference": "casualty_reference IS NULL",
        "member:casualty_severity_label": "casualty_severity_label NOT IN ('Fatal', 'Serious', 'Slight')",
    }) + " UNION ALL " + unique_sql("casualties", "casualties", "collision_id,casualty_reference"),
)
add(
    "Q_suite_count_points", lambda i: quality.suite(i.annual_points, "count_points"),
    rules_sql("count_points", "annual_points", {
        "null:count_point_id": "count_point_id IS NULL", "null:latitude": "latitude IS NULL", "null:longitude": "longitude IS NULL",
        "inside_area": f"NOT ({o.IN_AREA})", "not_blank:road_name": "trim(road_name) = ''",
    }) + " UNION ALL " + unique_sql("count_points", "annual_points", "count_point_id"),
)
add(
    "Q_suite_regions", lambda i: quality.suite(i.regions, "regions"),
    rules_sql("regions", "regions", {"null:id": "id IS NULL", "null:name": "name IS NULL", "not_blank:name": "trim(name) = ''"})
    + " UNION ALL " + unique_sql("regions", "regions", "id"),
)
add(
    "Q_suite_counts", lambda i: quality.suite(i.hourly_counts, "counts", 2000, 2020),
    rules_sql("counts", "hourly_counts", {
        "null:count_point_id": "count_point_id IS NULL", "year_range": "year NOT BETWEEN 2000 AND 2020",
        **{f"not_negative:{c}": f"{c} < 0" for c in ("cars_and_taxis", "all_hgvs", "pedal_cycles", "total_vehicles")},
        "total_covers_parts": "total_vehicles < cars_and_taxis + all_hgvs + pedal_cycles",
    }) + " UNION ALL " + unique_sql("counts", "hourly_counts", "count_point_id,year,count_date,hour,direction_of_travel"),
)
