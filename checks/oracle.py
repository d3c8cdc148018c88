"""SQL for DuckDB that says, independently, what each query must return.

``CTES`` names the building blocks; ``sql`` puts the ones a query needs in front
of it. Rounding goes through decimals, as DuckDB rounds doubles differently.
"""

from __future__ import annotations

import re


def rnd(expression: str, digits: int) -> str:
    """Round half up on the shortest decimal form of a double."""
    return f"CAST(ROUND(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


def pct(part: str, base: str) -> str:
    return rnd(f"CAST({part} AS DOUBLE) / NULLIF({base}, 0) * 100", 2)


def mean2(column: str, digits: int = 2) -> str:
    """Mean of values with a fixed number of decimals, summed as whole units."""
    unit = 10**digits
    return f"SUM(CAST(ROUND({column} * {unit}) AS BIGINT)) / (COUNT({column}) * {unit})"


def units_sum(column: str, digits: int) -> str:
    unit = 10**digits
    return f"SUM(CAST(ROUND({column} * {unit}) AS BIGINT)) / CAST({unit} AS DOUBLE)"


def total(column: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT)"


def growth(now: str, before: str) -> str:
    return pct(f"({now} - {before})", before)


def deduped(source: str, keys: str, order: str, highest: bool = False) -> str:
    ordering = ", ".join(f"{c.strip()} {'DESC' if highest else 'ASC'} NULLS LAST" for c in order.split(","))
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} "
        f"ORDER BY {ordering}) AS rn FROM {source}) WHERE rn = 1"
    )


def words(column: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({column})), ' '), "
        "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
    )


def co2(kind: str, factor: int) -> str:
    return f"ROUND(CAST({kind} AS BIGINT) * {factor} * 0.0128, 2)"


CO2 = {
    kind: co2(kind, factor)
    for kind, factor in {
        "pedal_cycles": 0, "two_wheeled_motor_vehicles": 83, "cars_and_taxis": 164,
        "buses_and_coaches": 822, "lgvs": 209, "all_hgvs": 586,
    }.items()
}
TOTAL_CO2 = "(" + " + ".join(CO2.values()) + ")"


def co2_tonnes(expression: str) -> str:
    return f"CAST(ROUND(CAST(SUM({expression}) AS DECIMAL(28,2)) * 0.001, 2) AS DOUBLE)"


SUM_ALL = "CAST(pedal_cycles AS BIGINT) + two_wheeled_motor_vehicles + cars_and_taxis + buses_and_coaches + lgvs + all_hgvs"
IN_AREA = "latitude BETWEEN 49 AND 61 AND longitude BETWEEN -8 AND 2"

PERIOD = """CASE WHEN hour BETWEEN 7 AND 9 THEN 'morning_peak' WHEN hour BETWEEN 10 AND 15 THEN 'inter_peak'
 WHEN hour BETWEEN 16 AND 18 THEN 'evening_peak' WHEN hour BETWEEN 19 AND 22 THEN 'evening' ELSE 'night' END"""
SEVERITY = "CASE {c} WHEN 1 THEN 'Fatal' WHEN 2 THEN 'Serious' WHEN 3 THEN 'Slight' ELSE 'Unknown' END"
LIGHT = """CASE {c} WHEN 1 THEN 'Daylight' WHEN 4 THEN 'Darkness - lights lit'
 WHEN 5 THEN 'Darkness - lights unlit' WHEN 6 THEN 'Darkness - no lighting'
 WHEN 7 THEN 'Darkness - lighting unknown' ELSE 'Unknown' END"""
WEATHER = """CASE {c} WHEN 1 THEN 'Fine no high winds' WHEN 2 THEN 'Raining no high winds'
 WHEN 3 THEN 'Snowing no high winds' WHEN 4 THEN 'Fine + high winds' WHEN 5 THEN 'Raining + high winds'
 WHEN 6 THEN 'Snowing + high winds' WHEN 7 THEN 'Fog or mist' ELSE 'Other/Unknown' END"""
VEHICLE = """CASE WHEN {c} = 1 THEN 'Pedal cycle' WHEN {c} = 2 THEN 'Motorcycle 50cc and under'
 WHEN {c} = 3 THEN 'Motorcycle 125cc and under' WHEN {c} = 4 THEN 'Motorcycle over 125cc and up to 500cc'
 WHEN {c} = 5 THEN 'Motorcycle over 500cc' WHEN {c} = 8 THEN 'Taxi/Private hire car' WHEN {c} = 9 THEN 'Car'
 WHEN {c} = 10 THEN 'Minibus' WHEN {c} = 11 THEN 'Bus or coach' WHEN {c} BETWEEN 19 AND 21 THEN 'Goods vehicle'
 WHEN {c} = 90 THEN 'Other vehicle' ELSE 'Unknown' END"""
CASUALTY = """CASE WHEN {c} = 0 THEN 'Pedestrian' WHEN {c} = 1 THEN 'Cyclist'
 WHEN {c} BETWEEN 2 AND 5 OR {c} = 23 THEN 'Motorcyclist' WHEN {c} IN (8, 9) THEN 'Car occupant'
 WHEN {c} = 11 THEN 'Bus/coach occupant' WHEN {c} BETWEEN 19 AND 21 THEN 'Goods vehicle occupant'
 ELSE 'Other' END"""
SEX = "CASE {c} WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END"
DRIVER_AGE = """CASE WHEN {c} < 17 OR {c} IS NULL THEN 'Unknown' WHEN {c} <= 25 THEN '17-25' WHEN {c} <= 35 THEN '26-35'
 WHEN {c} <= 45 THEN '36-45' WHEN {c} <= 55 THEN '46-55' WHEN {c} <= 65 THEN '56-65' ELSE '65+' END"""
CASUALTY_AGE = """CASE WHEN {c} < 0 OR {c} IS NULL THEN 'Unknown' WHEN {c} <= 15 THEN '0-15' WHEN {c} <= 25 THEN '16-25'
 WHEN {c} <= 35 THEN '26-35' WHEN {c} <= 45 THEN '36-45' WHEN {c} <= 55 THEN '46-55'
 WHEN {c} <= 65 THEN '56-65' ELSE '65+' END"""
ROAD_CLASS = """CASE road_category WHEN 'TA' THEN 'Motorway/Trunk A' WHEN 'TM' THEN 'Motorway/Trunk A'
 WHEN 'PA' THEN 'Principal A' WHEN 'M' THEN 'Motorway' ELSE 'Minor/B Road' END"""
ROAD_CATEGORY = """CASE road_type WHEN 'Major' THEN 'A Road / Motorway' WHEN 'Minor' THEN 'B Road / Minor'
 ELSE 'Unclassified' END"""
ENERGY = """CASE WHEN fuel_type IN ('wind', 'solar', 'hydro') THEN 'Renewable' WHEN fuel_type = 'nuclear' THEN 'Nuclear'
 WHEN fuel_type IN ('gas', 'coal') THEN 'Fossil Fuel' ELSE 'Other' END"""
INTENSITY = """CASE WHEN {c} <= 50 THEN 'Very Low' WHEN {c} <= 100 THEN 'Low' WHEN {c} <= 200 THEN 'Moderate'
 WHEN {c} <= 300 THEN 'High' ELSE 'Very High' END"""
RISK = """CASE WHEN hotspot_rank <= 10 THEN 'Critical' WHEN hotspot_rank <= 50 THEN 'High'
 WHEN hotspot_rank <= 200 THEN 'Medium' ELSE 'Low' END"""
SPEED = """CASE WHEN speed_limit <= 30 THEN '20-30 mph' WHEN speed_limit <= 50 THEN '40-50 mph'
 WHEN speed_limit <= 60 THEN '60 mph' ELSE '70+ mph' END"""
AREA = "CASE WHEN is_urban THEN 'Urban' ELSE 'Rural' END"
EMISSION = """CASE WHEN co2_per_vehicle_kg <= 1.5 THEN 'Low Emission'
 WHEN co2_per_vehicle_kg <= 2.5 THEN 'Medium Emission' ELSE 'High Emission' END"""
TIER = """CASE WHEN green_transport_index >= 10 THEN 'Leading' WHEN green_transport_index >= 5 THEN 'Progressing'
 ELSE 'Lagging' END"""
CONGESTION = """CASE WHEN congestion_index >= 0.9 THEN 'Severely Congested' WHEN congestion_index >= 0.75 THEN 'Congested'
 WHEN congestion_index >= 0.5 THEN 'Moderate' ELSE 'Free Flow' END"""
PERIOD_SORT = """CASE time_period WHEN 'morning_peak' THEN 1 WHEN 'evening_peak' THEN 2 WHEN 'inter_peak' THEN 3
 WHEN 'evening' THEN 4 ELSE 5 END"""
COLLISION_PERIOD = """CASE WHEN hour BETWEEN 7 AND 9 THEN 'Morning Rush' WHEN hour BETWEEN 10 AND 15 THEN 'Midday'
 WHEN hour BETWEEN 16 AND 18 THEN 'Evening Rush' WHEN hour BETWEEN 19 AND 22 THEN 'Evening' ELSE 'Night' END"""

DATE_COLUMNS = """date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
 CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%A') AS day_name, strftime(date, '%B') AS month_name,
 dayofweek(date) IN (0, 6) AS is_weekend"""
FISCAL_COLUMNS = """CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
 CAST(CASE WHEN month(date) >= 4 THEN year(date) ELSE year(date) - 1 END AS INTEGER) AS fiscal_year,
 CAST(CASE WHEN month(date) IN (4, 5, 6) THEN 1 WHEN month(date) IN (7, 8, 9) THEN 2
  WHEN month(date) IN (10, 11, 12) THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter"""

SUMMARY_SUMS = ", ".join(
    f"{total(source)} AS {name}"
    for name, source in {
        "total_cars": "cars_and_taxis", "total_buses": "buses_and_coaches", "total_lgvs": "lgvs",
        "total_hgvs": "all_hgvs", "total_cycles": "pedal_cycles",
        "total_motorcycles": "two_wheeled_motor_vehicles", "total_motor_vehicles": "all_motor_vehicles",
        "total_all_vehicles": "total_vehicles",
    }.items()
)
MIX_SUMS = ", ".join(
    f"{total(source)} AS {name}"
    for name, source in {
        "cycles": "pedal_cycles", "motorcycles": "two_wheeled_motor_vehicles", "cars": "cars_and_taxis",
        "buses": "buses_and_coaches", "lgvs": "lgvs", "hgvs": "all_hgvs", "total": "total_vehicles",
    }.items()
)
MIX_SHARES = f"""{pct('cars', 'total')} AS car_share_pct, {pct('cycles', 'total')} AS cycle_share_pct,
 {pct('hgvs', 'total')} AS hgv_share_pct, {pct('buses', 'total')} AS bus_share_pct,
 {pct('(cycles + buses)', 'total')} AS green_transport_index"""


def mix_table(sums: str) -> str:
    return f"""SELECT *, {rnd('green_transport_index - prev_green_index', 2)} AS green_index_change FROM (
 SELECT *, LAG(green_transport_index) OVER (PARTITION BY region_name ORDER BY year) AS prev_green_index FROM (
 SELECT *, {MIX_SHARES} FROM {sums}))"""


CTES = {
    # ---------------------------------------------------------------- annual
    "regions": f"SELECT r_regionkey AS id, {words('r_name')} AS name FROM region",
    "authorities": f"""SELECT n_nationkey AS id, {words('n_name')} AS name,
 CAST(n_regionkey AS VARCHAR) AS region_id FROM nation""",
    "annual_typed": """SELECT CAST(l_partkey AS INTEGER) AS count_point_id,
 CASE WHEN l_orderkey % 101 <> 0 THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
 CAST(l_partkey % 6 AS INTEGER) AS region_id, CAST(l_partkey % 25 AS INTEGER) AS local_authority_id,
 'A' || (l_partkey % 200) AS road_name,
 CASE (l_partkey + l_linenumber) % 5 WHEN 0 THEN 'PA' WHEN 1 THEN 'TA' WHEN 2 THEN 'TM' WHEN 3 THEN 'M'
  ELSE 'MCU' END AS road_category,
 CASE l_suppkey % 3 WHEN 0 THEN 'Major' WHEN 1 THEN 'Minor' ELSE 'Other' END AS road_type,
 CASE WHEN l_orderkey % 89 <> 0 THEN (485 + l_partkey % 130) / 10.0::DOUBLE END AS latitude,
 (l_partkey % 110 - 85) / 10.0::DOUBLE AS longitude,
 CASE WHEN l_orderkey % 113 <> 0 THEN (1 + l_partkey % 50) / 10.0::DOUBLE END AS link_length_km,
 CAST(l_quantity AS INTEGER) AS pedal_cycles, CAST(l_suppkey % 20 AS INTEGER) AS two_wheeled_motor_vehicles,
 CAST(floor(l_extendedprice / 10) AS INTEGER) AS cars_and_taxis, CAST(l_suppkey % 30 AS INTEGER) AS buses_and_coaches,
 CAST(floor(l_extendedprice / 50) AS INTEGER) AS lgvs,
 CASE WHEN l_orderkey % 97 = 0 OR l_orderkey % 103 = 0 OR l_orderkey % 107 = 0 THEN NULL
  WHEN l_orderkey % 109 = 0 THEN 1500 WHEN l_orderkey % 1999 = 0 THEN 2147483647
  ELSE CAST(floor(l_extendedprice / 100) AS INTEGER) END AS all_hgvs,
 CAST(l_suppkey % 20 + floor(l_extendedprice / 10) + l_suppkey % 30 + floor(l_extendedprice / 50)
  + floor(l_extendedprice / 100) AS INTEGER) AS all_motor_vehicles, l_partkey, l_linenumber FROM lineitem""",
    "annual_counts": f"""SELECT * EXCLUDE (l_partkey, l_linenumber), {SUM_ALL} AS total_vehicles,
 {pct('all_hgvs', 'all_motor_vehicles')} AS hgv_percentage
 FROM annual_typed WHERE year IS NOT NULL AND {IN_AREA}""",
    "annual_points": deduped(
        f"""(SELECT count_point_id, CAST(region_id AS VARCHAR) AS region_id,
 CAST(local_authority_id AS VARCHAR) AS local_authority_id, road_name, road_category,
 CASE road_type WHEN 'Major' THEN ' Major ' WHEN 'Minor' THEN 'Minor ' ELSE 'Other' END AS road_type,
 latitude, longitude FROM annual_typed WHERE {IN_AREA})""",
        "count_point_id",
        "region_id, local_authority_id, road_name, road_category, road_type, latitude, longitude",
    ),
    "annual_named": """SELECT c.*, r.name AS region_name FROM annual_counts c JOIN regions r ON c.region_id = r.id""",
    "fact_traffic_summary": f"""SELECT *, {growth('total_all_vehicles', 'prev_year_vehicles')} AS yoy_change_pct FROM (
 SELECT *, total_lgvs + total_hgvs AS freight_vehicles,
 {pct('(total_cycles + total_buses)', 'total_all_vehicles')} AS green_transport_index,
 LAG(total_all_vehicles) OVER (PARTITION BY region_name, road_type ORDER BY year) AS prev_year_vehicles FROM (
 SELECT region_name, road_type, year, {SUMMARY_SUMS}, COUNT(DISTINCT count_point_id) AS count_points_observed,
 {mean2('hgv_percentage')} AS avg_hgv_pct FROM annual_named GROUP BY region_name, road_type, year))""",
    "fact_co2_annual": f"""SELECT *,
 {rnd('total_co2_tonnes * 1000 / NULLIF(total_vehicle_count, 0)', 2)} AS co2_per_vehicle_kg FROM (
 SELECT region_name, road_type, year, {co2_tonnes(TOTAL_CO2)} AS total_co2_tonnes,
 {co2_tonnes(CO2['cars_and_taxis'])} AS car_co2_tonnes, {co2_tonnes(CO2['all_hgvs'])} AS hgv_co2_tonnes,
 {total('all_motor_vehicles')} AS total_vehicle_count FROM annual_named GROUP BY region_name, road_type, year)""",
    "mix_annual_sums": f"SELECT region_name, year, {MIX_SUMS} FROM annual_named GROUP BY region_name, year",
    "fact_mix_annual": mix_table("mix_annual_sums"),
    "fact_road": f"""SELECT *, {rnd('total_motor_vehicles / NULLIF(avg_link_length_km, 0)', 0)} AS vehicles_per_km FROM (
 SELECT region_name, {ROAD_CLASS} AS road_class, road_name, year, {total('all_motor_vehicles')} AS total_motor_vehicles,
 {total('all_hgvs')} AS total_hgvs, {total('pedal_cycles')} AS total_cycles,
 {mean2('link_length_km', 6)} AS avg_link_length_km, COUNT(DISTINCT count_point_id) AS count_points
 FROM annual_named GROUP BY ALL)""",
    "impact_sums": f"""SELECT region_name, road_type, year, {total('all_motor_vehicles')} AS total_vehicles,
 {total('pedal_cycles')} AS total_cycles, {total('all_hgvs')} AS total_hgvs FROM annual_named
 WHERE year BETWEEN 1996 AND 2001 GROUP BY region_name, road_type, year""",
    "fact_impact": f"""SELECT i.*, b.total_vehicles AS baseline_1996,
 {pct('i.total_vehicles', 'b.total_vehicles')} AS recovery_pct,
 i.total_vehicles - LAG(i.total_vehicles) OVER (PARTITION BY i.region_name, i.road_type ORDER BY i.year) AS yoy_change
 FROM impact_sums i LEFT JOIN impact_sums b
 ON b.year = 1996 AND i.region_name = b.region_name AND i.road_type = b.road_type""",
    "fact_busiest": f"""SELECT * FROM (SELECT *, CAST(DENSE_RANK() OVER (ORDER BY total_vehicles DESC) AS INTEGER) AS rank FROM (
 SELECT region_name, road_name, road_type, latitude, longitude, {total('all_motor_vehicles')} AS total_vehicles,
 {total('all_hgvs')} AS total_hgvs, {total('pedal_cycles')} AS total_cycles FROM annual_named
 WHERE year = (SELECT MAX(year) FROM annual_counts) GROUP BY ALL)) WHERE rank <= 500""",
    "location": f"""SELECT *, {ROAD_CLASS} AS road_class FROM ("""
    + deduped(
        """(SELECT c.count_point_id, c.road_name, c.road_type, c.road_category, c.region_name,
 a.name AS local_authority_name, c.latitude, c.longitude
 FROM annual_named c JOIN authorities a ON c.local_authority_id = a.id)""",
        "count_point_id",
        "road_name, road_type, road_category, region_name, local_authority_name, latitude, longitude",
    )
    + ")",
    "annual_days": """SELECT CAST(unnest(generate_series(make_date(a, 1, 1), make_date(b, 12, 31), INTERVAL 1 DAY)) AS DATE)
 AS date FROM (SELECT min(year) AS a, max(year) AS b FROM annual_counts)""",
    "annual_dates": f"SELECT {DATE_COLUMNS} FROM annual_days",
    # ---------------------------------------------------------------- hourly
    "hourly_points_typed": """SELECT CAST(c_custkey AS INTEGER) AS count_point_id, 'A' || (c_custkey % 200) AS road_name,
 CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Major' WHEN c_mktsegment = 'FURNITURE' THEN 'Other'
  ELSE 'Minor' END AS road_type,
 'Region ' || (c_nationkey % 5) AS region_name, 'Authority ' || c_nationkey AS local_authority_name,
 CASE WHEN c_custkey % 53 <> 0 THEN (480 + c_custkey % 140) / 10.0::DOUBLE END AS latitude,
 (c_custkey % 120 - 90) / 10.0::DOUBLE AS longitude FROM customer""",
    "hourly_points": f"SELECT * FROM hourly_points_typed WHERE {IN_AREA}",
    "hourly_days": """SELECT *, CAST(ts AS DATE)
 - to_years(CAST(CASE WHEN event_id % 7 = 6 THEN 30 ELSE event_id % 7 END AS INTEGER)) AS moved FROM events""",
    "hourly_typed": """SELECT CAST(user_id AS INTEGER) AS count_point_id, CAST(year(moved) AS INTEGER) AS year,
 CAST(moved AS DATE) AS count_date, CAST(hour(ts) AS INTEGER) AS hour,
 CASE event_id % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'S' WHEN 2 THEN 'E' ELSE 'W' END AS direction_of_travel,
 CAST(CASE WHEN event_type = 'view' THEN floor(value) ELSE event_id % 5 END AS INTEGER) AS pedal_cycles,
 CAST(event_id % 7 AS INTEGER) AS two_wheeled_motor_vehicles, CAST(floor(value) + 10 AS INTEGER) AS cars_and_taxis,
 CAST(CASE WHEN event_type = 'click' THEN floor(value) ELSE 2 END AS INTEGER) AS buses_and_coaches,
 CAST(user_id % 40 AS INTEGER) AS lgvs,
 CASE WHEN event_type <> 'error' THEN CAST(event_id % 60 AS INTEGER) END AS all_hgvs,
 CAST(floor(value) + 100 AS INTEGER) AS all_motor_vehicles FROM hourly_days""",
    "hourly_kept": deduped(
        "hourly_typed WHERE year >= 2000 AND count_point_id IS NOT NULL",
        "count_point_id, year, count_date, hour, direction_of_travel",
        "pedal_cycles, two_wheeled_motor_vehicles, cars_and_taxis, buses_and_coaches, lgvs, all_hgvs, all_motor_vehicles",
    ),
    "hourly_counts": f"""SELECT *, {pct('all_hgvs', 'total_vehicles')} AS hgv_percentage, {PERIOD} AS time_period
 FROM (SELECT *, {SUM_ALL} AS total_vehicles FROM hourly_kept)""",
    "daily": f"""SELECT *, total_motorcycles + total_cars + total_buses + total_lgvs + total_hgvs AS motorised_vehicles,
 total_pedal_cycles AS active_travel_vehicles, total_lgvs + total_hgvs AS freight_vehicles FROM (
 SELECT count_point_id, year, count_date, direction_of_travel, {total('pedal_cycles')} AS total_pedal_cycles,
 {total('two_wheeled_motor_vehicles')} AS total_motorcycles, {total('cars_and_taxis')} AS total_cars,
 {total('buses_and_coaches')} AS total_buses, {total('lgvs')} AS total_lgvs, {total('all_hgvs')} AS total_hgvs,
 {total('total_vehicles')} AS total_all_vehicles, {mean2('hgv_percentage')} AS avg_hgv_percentage,
 COUNT(*) AS hours_counted FROM hourly_counts GROUP BY ALL)""",
    "peaks": f"""SELECT *, {rnd('avg_vehicles / NULLIF(max_vehicles, 0)', 3)} AS congestion_index FROM (
 SELECT count_point_id, year, hour, time_period, AVG(total_vehicles) AS avg_vehicles, MAX(total_vehicles) AS max_vehicles,
 MIN(total_vehicles) AS min_vehicles, AVG(cars_and_taxis) AS avg_cars, AVG(all_hgvs) AS avg_hgvs,
 COUNT(*) AS observation_count FROM hourly_counts GROUP BY count_point_id, year, hour, time_period)""",
    "hourly_named": """SELECT c.*, p.region_name, p.local_authority_name, p.road_type
 FROM hourly_counts c JOIN hourly_points p ON c.count_point_id = p.count_point_id""",
    "yoy": f"""SELECT *, {growth('total_vehicles', 'prev_year_vehicles')} AS yoy_change_pct FROM (
 SELECT *, LAG(total_vehicles) OVER (PARTITION BY region_name, road_type ORDER BY year) AS prev_year_vehicles FROM (
 SELECT region_name, road_type, year, {total('total_vehicles')} AS total_vehicles, {total('cars_and_taxis')} AS total_cars,
 {total('all_hgvs')} AS total_hgvs, {total('pedal_cycles')} AS total_cycles,
 COUNT(DISTINCT count_point_id) AS count_points_observed FROM hourly_named GROUP BY region_name, road_type, year))""",
    "fact_co2_hourly": f"""SELECT *,
 {rnd('total_co2_tonnes * 1000 / NULLIF(total_vehicle_count, 0)', 2)} AS co2_per_vehicle_kg FROM (
 SELECT region_name, local_authority_name, road_type, year, {co2_tonnes(TOTAL_CO2)} AS total_co2_tonnes,
 {co2_tonnes(CO2['cars_and_taxis'])} AS car_co2_tonnes, {co2_tonnes(CO2['all_hgvs'])} AS hgv_co2_tonnes,
 CAST(SUM({CO2['buses_and_coaches']}) AS DOUBLE) AS bus_co2_tonnes, CAST(SUM({CO2['lgvs']}) AS DOUBLE) AS lgv_co2_tonnes,
 {total('total_vehicles')} AS total_vehicle_count, {total('pedal_cycles')} AS total_cycle_count,
 COUNT(DISTINCT count_point_id) AS observation_points FROM hourly_named GROUP BY ALL)""",
    "mix_hourly_sums": f"SELECT region_name, year, {MIX_SUMS} FROM hourly_named GROUP BY region_name, year",
    "fact_mix_hourly": mix_table("mix_hourly_sums"),
    "active_travel": f"""SELECT *, {rnd('cycle_mode_share - prev_cycle_share', 2)} AS cycle_share_change FROM (
 SELECT *, LAG(cycle_mode_share) OVER (PARTITION BY region_name, local_authority_name ORDER BY year) AS prev_cycle_share
 FROM (SELECT *, {pct('total_cycles', 'total_all_vehicles')} AS cycle_mode_share,
 {rnd('total_cycles / observation_points', 0)} AS cycles_per_observation_point FROM (
 SELECT region_name, local_authority_name, year, {total('pedal_cycles')} AS total_cycles,
 {total('total_vehicles')} AS total_all_vehicles, COUNT(DISTINCT count_point_id) AS observation_points
 FROM hourly_named GROUP BY ALL)))""",
    "point_dim": f"SELECT *, {ROAD_CATEGORY} AS road_category FROM hourly_points",
    "hourly_days_all": """SELECT CAST(unnest(generate_series(make_date(a, 1, 1), make_date(b, 12, 31), INTERVAL 1 DAY)) AS DATE)
 AS date FROM (SELECT min(year) AS a, max(year) AS b FROM hourly_counts)""",
    "hourly_dates": f"SELECT {DATE_COLUMNS}, {FISCAL_COLUMNS} FROM hourly_days_all",
    "capacity": f"""SELECT p.region_name, p.road_type, p.road_category, h.year,
 COUNT(DISTINCT h.count_point_id) AS total_count_points, {mean2('h.congestion_index', 3)} AS avg_congestion_index,
 COUNT(*) FILTER (h.congestion_index >= 0.9) AS severely_congested_count,
 COUNT(*) FILTER (h.congestion_index >= 0.75) AS congested_count,
 COUNT(*) FILTER (h.congestion_index < 0.5) AS free_flow_count,
 {rnd('COUNT(*) FILTER (h.congestion_index >= 0.75) / COUNT(*) * 100', 4)} AS pct_congested
 FROM peaks h JOIN point_dim p ON h.count_point_id = p.count_point_id
 WHERE h.time_period IN ('morning_peak', 'evening_peak') GROUP BY ALL""",
    # ---------------------------------------------------------------- safety
    "collisions_typed": """SELECT
 CAST(CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS VARCHAR) AS collision_id,
 strftime(o_orderdate, '%d/%m/%Y') AS date,
 CASE WHEN o_orderkey % 31 <> 0 THEN lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':'
  || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') END AS time,
 (48500 + (o_custkey * 7) % 13000) / 1000.0::DOUBLE AS latitude,
 ((o_custkey * 11) % 11000 - 8500) / 1000.0::DOUBLE AS longitude,
 CAST(1 + o_orderkey % 3 AS INTEGER) AS number_of_vehicles, CAST(1 + o_orderkey % 4 AS INTEGER) AS number_of_casualties,
 CAST(20 + 10 * (o_custkey % 6) AS INTEGER) AS speed_limit, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS accident_severity,
 CAST(1 + o_orderkey % 2 AS INTEGER) AS urban_or_rural_area, CAST(o_orderkey % 8 AS INTEGER) AS light_conditions,
 CAST(o_orderkey % 9 AS INTEGER) AS weather_conditions, CAST(o_orderdate AS DATE) AS collision_date FROM orders""",
    "collisions_kept": deduped(
        f"collisions_typed WHERE {IN_AREA}", "collision_id",
        "date, time, latitude, longitude, number_of_vehicles, number_of_casualties, speed_limit, "
        "accident_severity, urban_or_rural_area, light_conditions, weather_conditions",
    ),
    "collisions": f"""SELECT *, CAST(year(collision_date) AS INTEGER) AS collision_year,
 CAST(month(collision_date) AS INTEGER) AS collision_month, CAST(dayofweek(collision_date) + 1 AS INTEGER) AS day_of_week,
 {SEVERITY.format(c='accident_severity')} AS severity_label, urban_or_rural_area = 1 AS is_urban,
 {LIGHT.format(c='light_conditions')} AS light_condition_label, {WEATHER.format(c='weather_conditions')} AS weather_label
 FROM collisions_kept""",
    "vehicles_kept": deduped(
        """(SELECT CAST(l_orderkey AS VARCHAR) AS collision_id, l_linenumber AS vehicle_reference,
 CASE WHEN l_partkey % 97 = 0 THEN 90 ELSE CAST(l_partkey % 25 AS INTEGER) END AS vehicle_type,
 CAST(l_quantity AS INTEGER) * 2 AS age_of_driver,
 CASE WHEN l_suppkey % 20 <> 19 THEN CAST(l_suppkey % 20 AS INTEGER) END AS age_of_vehicle,
 CAST(floor(l_extendedprice) AS INTEGER) AS engine_capacity_cc FROM lineitem)""",
        "collision_id, vehicle_reference", "vehicle_type, age_of_driver, age_of_vehicle, engine_capacity_cc",
    ),
    "vehicles": f"""SELECT *, {VEHICLE.format(c='vehicle_type')} AS vehicle_type_label,
 {DRIVER_AGE.format(c='age_of_driver')} AS driver_age_band FROM vehicles_kept""",
    "casualties_kept": deduped(
        """(SELECT CAST(l_orderkey AS VARCHAR) AS collision_id, l_linenumber AS casualty_reference,
 CAST(1 + l_suppkey % 4 AS INTEGER) AS casualty_severity, CAST(l_quantity AS INTEGER) * 2 - 1 AS age_of_casualty,
 CAST(l_partkey % 25 AS INTEGER) AS casualty_type, CAST(1 + l_suppkey % 3 AS INTEGER) AS sex_of_casualty FROM lineitem)""",
        "collision_id, casualty_reference", "casualty_severity, age_of_casualty, casualty_type, sex_of_casualty",
    ),
    "casualties": f"""SELECT *, {SEVERITY.format(c='casualty_severity')} AS casualty_severity_label,
 {CASUALTY_AGE.format(c='age_of_casualty')} AS casualty_age_band,
 {CASUALTY.format(c='casualty_type')} AS casualty_type_label, {SEX.format(c='sex_of_casualty')} AS sex_label
 FROM casualties_kept""",
    "accident_summary": f"""SELECT *, fatal_count + serious_count AS ksi_count,
 {pct('(fatal_count + serious_count)', 'total_collisions')} AS ksi_rate FROM (
 SELECT collision_year, collision_month, severity_label, weather_label, light_condition_label, is_urban, speed_limit,
 COUNT(*) AS total_collisions, {total('number_of_casualties')} AS total_casualties,
 {total('number_of_vehicles')} AS total_vehicles_involved, AVG(number_of_casualties) AS avg_casualties_per_collision,
 COUNT(*) FILTER (severity_label = 'Fatal') AS fatal_count, COUNT(*) FILTER (severity_label = 'Serious') AS serious_count,
 COUNT(*) FILTER (severity_label = 'Slight') AS slight_count FROM collisions GROUP BY ALL)""",
    "hotspots": f"""SELECT *, DENSE_RANK() OVER (PARTITION BY collision_year ORDER BY severity_score DESC)::INTEGER
 AS hotspot_rank FROM (SELECT *, fatal_incidents * 10 + serious_incidents * 5
 + (total_incidents - fatal_incidents - serious_incidents) AS severity_score FROM (
 SELECT {rnd('latitude', 2)} AS lat_grid, {rnd('longitude', 2)} AS lon_grid, collision_year, COUNT(*) AS total_incidents,
 COUNT(*) FILTER (severity_label = 'Fatal') AS fatal_incidents,
 COUNT(*) FILTER (severity_label = 'Serious') AS serious_incidents, {total('number_of_casualties')} AS total_casualties,
 AVG(speed_limit) AS avg_speed_limit, MIN(is_urban) AS is_urban FROM collisions GROUP BY 1, 2, 3))""",
    # ---------------------------------------------------------------- events
    "event_base": """SELECT *, date_trunc('hour', ts) AS cycle, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
 CASE event_type WHEN 'view' THEN 'national_intensity' WHEN 'click' THEN 'generation_mix'
  WHEN 'purchase' THEN 'regional_intensity' WHEN 'signup' THEN 'regional_generation' END AS kind,
 date_trunc('hour', ts) + CASE WHEN minute(ts) < 30 THEN INTERVAL 0 MINUTE ELSE INTERVAL 30 MINUTE END AS since
 FROM events""",
    "carbon_events": """SELECT cycle AS event_time, kind AS event_type, CASE WHEN kind IS NOT NULL THEN cycle END AS data_timestamp,
 CASE WHEN kind <> 'regional_generation' THEN strftime(since, '%Y-%m-%dT%H:%MZ') END AS period_from,
 CASE WHEN kind <> 'regional_generation' THEN strftime(since + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%MZ') END AS period_to,
 CASE WHEN kind LIKE '%_intensity' THEN value END AS forecast,
 CASE WHEN kind = 'national_intensity' THEN value + k - 50 END AS actual,
 CASE WHEN kind LIKE '%_intensity' THEN CASE k % 5 WHEN 0 THEN 'very low' WHEN 1 THEN 'low' WHEN 2 THEN 'moderate'
  WHEN 3 THEN 'high' ELSE 'very high' END END AS intensity_index,
 CASE WHEN kind IN ('generation_mix', 'regional_generation') THEN CASE k % 9 WHEN 0 THEN 'biomass' WHEN 1 THEN 'coal'
  WHEN 2 THEN 'imports' WHEN 3 THEN 'gas' WHEN 4 THEN 'nuclear' WHEN 5 THEN 'other' WHEN 6 THEN 'hydro'
  WHEN 7 THEN 'solar' ELSE 'wind' END END AS fuel_type,
 CASE WHEN kind IN ('generation_mix', 'regional_generation') THEN k / 10.0::DOUBLE END AS fuel_percentage,
 CASE WHEN kind LIKE 'regional%' THEN CAST(1 + user_id % 17 AS INTEGER) END AS region_id,
 CASE WHEN kind LIKE 'regional%' THEN 'Region ' || (1 + user_id % 17) END AS region_name,
 CASE WHEN kind = 'regional_intensity' THEN 'DNO ' || (1 + user_id % 17) END AS dno_region FROM event_base""",
    "latest_events": "SELECT * FROM carbon_events WHERE data_timestamp = (SELECT max(data_timestamp) FROM carbon_events)",
}


def national(source: str) -> str:
    kept = deduped(
        f"""(SELECT data_timestamp, period_from, period_to, forecast, actual, intensity_index FROM {source}
 WHERE event_type = 'national_intensity')""",
        "period_from", "data_timestamp, period_to, forecast, actual, intensity_index", highest=True,
    )
    return (
        f"SELECT *, {rnd('actual - forecast', 2)} AS forecast_vs_actual, "
        f"{INTENSITY.format(c='actual')} AS intensity_category FROM ({kept})"
    )


def fuel_mix(source: str) -> str:
    kept = deduped(
        f"""(SELECT data_timestamp, period_from, period_to, fuel_type, fuel_percentage FROM {source}
 WHERE event_type = 'generation_mix')""",
        "period_from, fuel_type", "data_timestamp, period_to, fuel_percentage", highest=True,
    )
    return f"SELECT *, {ENERGY} AS energy_category FROM ({kept})"


def regional(source: str) -> str:
    kept = deduped(
        f"""(SELECT data_timestamp, period_from, period_to, region_id, region_name, dno_region, forecast,
 intensity_index FROM {source} WHERE event_type = 'regional_intensity')""",
        "period_from, region_id", "data_timestamp, period_to, region_name, dno_region, forecast, intensity_index", highest=True,
    )
    return f"SELECT *, {INTENSITY.format(c='forecast')} AS intensity_category FROM ({kept})"


def regional_fuels(source: str) -> str:
    kept = deduped(
        f"""(SELECT data_timestamp, period_from, region_id, region_name, fuel_type, fuel_percentage FROM {source}
 WHERE event_type = 'regional_generation')""",
        "coalesce(period_from, CAST(data_timestamp AS VARCHAR)), region_id, fuel_type", "data_timestamp, period_from, region_name, fuel_percentage", highest=True,
    )
    return f"SELECT *, {ENERGY} AS energy_category FROM ({kept})"


def renewables(source: str) -> str:
    return (
        f"SELECT period_from, energy_category, {units_sum('fuel_percentage', 6)} AS total_percentage "
        f"FROM ({fuel_mix(source)}) GROUP BY period_from, energy_category"
    )


# Gold table on events -> its SQL over a table of parsed events.
EVENT_SQL = {
    "gold_national_intensity": national,
    "gold_generation_mix": fuel_mix,
    "gold_regional_intensity": regional,
    "gold_regional_generation": regional_fuels,
    "gold_renewable_summary": renewables,
}
NAMES = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def sql(body: str) -> str:
    """The query with the building blocks it needs in front, each after its own needs."""
    ordered: list[str] = []
    seen: set[str] = set()

    def need(text: str) -> None:
        for name in dict.fromkeys(NAMES.findall(text)):
            if name not in seen:
                seen.add(name)
                need(CTES[name])
                ordered.append(name)

    need(body)
    blocks = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    return f"WITH {blocks}\n{body}" if blocks else body
