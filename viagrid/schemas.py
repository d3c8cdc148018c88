"""Source contracts, as Spark DDL.

The names are fixed values: they are the field names the feeds use.
"""

PAGE_FIELDS = "current_page int, last_page int, total long, per_page int"

REGIONS = "id int, name string, ons_code string, country_id int"

LOCAL_AUTHORITIES = "id int, name string, region_id int, ita_id int, ons_code string"

COUNT_POINTS = (
    "count_point_id int, region_id int, local_authority_id int, road_name string, "
    "road_category string, road_type string, latitude double, longitude double, "
    "easting int, northing int"
)

COUNTS_ANNUAL = (
    "id int, count_point_id int, year int, region_id int, local_authority_id int, "
    "road_name string, road_category string, road_type string, "
    "start_junction_road_name string, end_junction_road_name string, "
    "easting int, northing int, latitude double, longitude double, "
    "link_length_km double, link_length_miles double, "
    "estimation_method string, estimation_method_detailed string, "
    "pedal_cycles int, two_wheeled_motor_vehicles int, cars_and_taxis int, "
    "buses_and_coaches int, lgvs int, hgvs_2_rigid_axle int, hgvs_3_rigid_axle int, "
    "hgvs_4_or_more_rigid_axle int, hgvs_3_or_4_articulated_axle int, "
    "hgvs_5_articulated_axle int, hgvs_6_articulated_axle int, "
    "all_hgvs int, all_motor_vehicles int"
)

COUNTS_HOURLY = (
    "count_point_id int, year int, count_date string, hour int, direction_of_travel string, "
    "pedal_cycles int, two_wheeled_motor_vehicles int, cars_and_taxis int, "
    "buses_and_coaches int, lgvs int, all_hgvs int, all_motor_vehicles int"
)

# Ids and the time of day stay text: inference would turn them into numbers and
# into a timestamp on today's date.
COLLISIONS = (
    "accident_index string, date string, time string, latitude double, longitude double, "
    "number_of_vehicles int, number_of_casualties int, speed_limit int, "
    "accident_severity int, urban_or_rural_area int, light_conditions int, weather_conditions int"
)

VEHICLES = (
    "accident_index string, vehicle_reference int, vehicle_type int, "
    "age_of_driver int, age_of_vehicle int, engine_capacity_cc int"
)

CASUALTIES = (
    "accident_index string, casualty_reference int, casualty_severity int, "
    "age_of_casualty int, casualty_type int, sex_of_casualty int"
)

EVENT_ENVELOPE = "raw_json string, partition_id string, enqueued_time string, sequence_number long"

EVENT_PAYLOAD = (
    "event_type string, timestamp string, `from` string, `to` string, "
    "forecast double, actual double, `index` string, fuel string, percentage double, "
    "region_id int, region_name string, dno_region string"
)

FUEL_SHARE = "struct<fuel: string, perc: double>"

# One poll of the three feeds: national intensity, national mix, regional detail.
SNAPSHOT = (
    "polled_at string, "
    "national struct<`from`: string, `to`: string, "
    "intensity: struct<forecast: double, actual: double, `index`: string>>, "
    f"generation struct<`from`: string, `to`: string, generationmix: array<{FUEL_SHARE}>>, "
    "regional struct<`from`: string, `to`: string, regions: array<struct<"
    "regionid: int, shortname: string, dnoregion: string, "
    f"intensity: struct<forecast: double, `index`: string>, generationmix: array<{FUEL_SHARE}>>>>"
)


def as_text(ddl: str) -> str:
    """The same flat columns, all STRING: the raw-layer form of a contract."""
    return ", ".join(f"{part.split()[0]} string" for part in ddl.split(", "))
