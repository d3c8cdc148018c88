import collections

import pytest
from pyspark.sql import functions as F

from viagrid.plans import hourly, safety, serving, silver


@pytest.fixture(scope="module")
def counts(spark):
    """Hourly counts of which one point holds a third, with repeats."""
    n = F.col("id")
    raw = spark.range(9_000).select(
        F.when(n % 3 == 0, 0).otherwise(n % 40).cast("int").alias("count_point_id"),
        (2019 + n % 3).cast("int").alias("year"),
        F.concat(2019 + n % 3, F.lit("-05-"), F.lpad((1 + n % 28).cast("string"), 2, "0")).alias("count_date"),
        (n % 24).cast("int").alias("hour"), F.element_at(F.array(F.lit(" n"), F.lit("s")), (1 + n % 2).cast("int")).alias("direction_of_travel"),
        (n % 11).cast("int").alias("pedal_cycles"), (n % 5).cast("int").alias("two_wheeled_motor_vehicles"),
        (n % 101).cast("int").alias("cars_and_taxis"), (n % 3).cast("int").alias("buses_and_coaches"),
        (n % 7).cast("int").alias("lgvs"), (n % 13).cast("int").alias("all_hgvs"), (n % 200).cast("int").alias("all_motor_vehicles"))
    return silver.hourly_counts(raw).cache()


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, f"a{i}", "Major" if i % 2 else "Minor", f"region {i % 3}", f"la {i % 5}", 51.0, -1.0) for i in range(30)]
    return silver.hourly_count_points(spark.createDataFrame(
        rows, "id int, road_name string, road_type string, region_name string, local_authority_name string,"
        " latitude double, longitude double"))


def test_regional_sums_equal_direct_aggregation(counts, points, values):
    direct = (
        counts.join(points.select("count_point_id", "region_name", "road_type"), "count_point_id")
        .groupBy("region_name", "road_type", "year")
        .agg(F.sum("total_vehicles").alias("total_vehicles"), F.count_distinct("count_point_id").alias("count_points_observed"))
    )
    ours = hourly.yoy_regional(counts, points)
    assert values(ours, *direct.columns) == values(direct)


def test_a_hot_point_meets_the_points_as_one_row_per_year(counts):
    hot = hourly.point_years(counts).filter("count_point_id = 0")
    assert hot.count() == 3


def test_capacity_equals_direct_aggregation(counts, points):
    peaks, dim = hourly.hourly_peaks(counts), hourly.count_point_dim(points)
    joined = peaks.filter(F.col("time_period").isin(*hourly.TWO_PEAKS)).join(dim, "count_point_id").collect()
    groups = collections.defaultdict(list)
    for row in joined:
        groups[(row.region_name, row.road_type, row.road_category, row.year)].append(row)
    for row in hourly.capacity_utilisation(peaks, dim).collect():
        members = groups.pop((row.region_name, row.road_type, row.road_category, row.year))
        rated = [m.congestion_index for m in members if m.congestion_index is not None]
        assert row.total_count_points == len({m.count_point_id for m in members})
        assert row.avg_congestion_index == pytest.approx(sum(rated) / len(rated))
        assert row.congested_count == sum(r >= 0.75 for r in rated)
        assert row.pct_congested == pytest.approx(100 * row.congested_count / len(members), abs=1e-4)
    assert not groups


def test_mix_shares_add_up(counts, points):
    for row in hourly.vehicle_mix(counts, points).collect():
        parts = row.cycles + row.motorcycles + row.cars + row.buses + row.lgvs + row.hgvs
        assert parts == row.total
        assert row.green_transport_index == pytest.approx(100 * (row.cycles + row.buses) / row.total, abs=0.01)


def test_view_rows_are_the_daily_rows_with_a_known_point(counts, points):
    from viagrid.plans import dates

    daily, dim = hourly.daily_traffic(counts), hourly.count_point_dim(points)
    days = dates.date_dim_fiscal(dates.spine_of(counts))
    view = serving.traffic_summary(daily, dim, days, hourly.yoy_regional(counts, points))
    assert view.count() == daily.join(dim, "count_point_id").count()
    assert len(view.columns) == 28


@pytest.fixture(scope="module")
def accidents(spark):
    collisions = silver.collisions(spark.createDataFrame(
        [(str(i), f"{1 + i % 28:02d}/03/20{18 + i % 3}", f"{i % 24}:30", 51.0 + i % 4 / 100, -1.0, 2, 1 + i % 3,
          20 + 10 * (i % 6), 1 + i % 4, 1 + i % 2, i % 8, i % 9) for i in range(300)],
        "accident_index string, date string, time string, latitude double, longitude double, number_of_vehicles int,"
        " number_of_casualties int, speed_limit int, accident_severity int, urban_or_rural_area int,"
        " light_conditions int, weather_conditions int"))
    n = F.col("id")
    vehicles = silver.vehicles(spark.range(6_000).select(
        F.when(n % 3 == 0, "7").otherwise((n % 400).cast("string")).alias("accident_index"),
        n.cast("int").alias("vehicle_reference"), (n % 25).cast("int").alias("vehicle_type"),
        (n % 90).cast("int").alias("age_of_driver"), F.when(n % 4 != 0, n % 20).cast("int").alias("age_of_vehicle"),
        (n % 3000).cast("int").alias("engine_capacity_cc")))
    return collisions, vehicles


def test_vehicle_means_equal_direct_aggregation(accidents, values):
    collisions, vehicles = accidents
    group = ["collision_year", "vehicle_type_label", "driver_age_band", "severity_label"]
    direct = vehicles.join(collisions, "collision_id").groupBy(*group).agg(
        F.count("*").alias("vehicle_count"), F.avg("age_of_vehicle").alias("avg_vehicle_age"),
        F.avg("engine_capacity_cc").alias("avg_engine_cc"))
    assert values(safety.vehicle_analysis(vehicles, collisions), *direct.columns) == values(direct)


def test_hotspot_scores_and_ranks(accidents):
    collisions, _ = accidents
    spots = safety.accident_hotspots(collisions).collect()
    assert sum(s.total_incidents for s in spots) == 300
    for s in spots:
        other = s.total_incidents - s.fatal_incidents - s.serious_incidents
        assert s.severity_score == 10 * s.fatal_incidents + 5 * s.serious_incidents + other
    for year in {s.collision_year for s in spots}:
        scores = sorted({s.severity_score for s in spots if s.collision_year == year}, reverse=True)
        assert all(s.hotspot_rank == 1 + scores.index(s.severity_score) for s in spots if s.collision_year == year)


def test_ksi_counts(accidents):
    for row in safety.accident_summary(accidents[0]).collect():
        assert row.ksi_count == row.fatal_count + row.serious_count <= row.total_collisions


def test_domain_run_writes_what_the_tables_say(spark, tmp_path, values):
    from checks.standins import Inputs
    from viagrid.plans import dates, domain

    i = Inputs(spark, "/root/testdata/sf0.001")
    raw = {
        "count_points": i.hourly_points_raw, "counts": i.hourly_raw, "regions": i.regions_raw,
        "local_authorities": i.authorities_raw, "collisions": i.collisions_raw,
        "vehicles": i.vehicles_raw, "casualties": i.casualties_raw,
    }
    paths = domain.run(spark, raw, str(tmp_path), dates.spine_of(i.hourly_counts))
    direct = domain.gold_tables(domain.silver_tables(raw), dates.spine_of(i.hourly_counts))
    assert set(paths) == set(direct) == set(domain.GOLD_LAYOUT)
    for name, path in paths.items():
        columns = sorted(direct[name].columns)
        assert values(spark.read.parquet(path), *columns) == values(direct[name], *columns), name
    assert (tmp_path / "gold/fact_co2_emissions").exists() and list((tmp_path / "silver/counts").glob("year=*"))


def test_a_gate_holds_back_rows_or_the_whole_run(spark, tmp_path, values):
    from checks.standins import Inputs
    from viagrid.operators.quality import RuleViolated
    from viagrid.operators.quarantine import Gate
    from viagrid.plans import dates, domain

    i = Inputs(spark, "/root/testdata/sf0.001")
    raw = {
        "count_points": i.hourly_points_raw, "counts": i.hourly_raw, "regions": i.regions_raw,
        "local_authorities": i.authorities_raw, "collisions": i.collisions_raw,
        "vehicles": i.vehicles_raw, "casualties": i.casualties_raw,
    }
    odd = {**raw, "collisions": raw["collisions"].withColumn("speed_limit", F.when(F.hash("accident_index") % 9 == 0, 35).otherwise(30))}
    days = dates.spine_of(i.hourly_counts)
    with pytest.raises(RuleViolated, match="speed_limit"):
        domain.run(spark, odd, str(tmp_path / "refused"), days, Gate(most=0.02))
    assert not (tmp_path / "refused").exists()
    domain.run(spark, odd, str(tmp_path / "kept"), days, Gate(most=1.0))
    whole = domain.silver_tables(odd)["collisions"]
    good = spark.read.parquet(str(tmp_path / "kept/silver/collisions"))
    aside = spark.read.parquet(str(tmp_path / "kept/quarantine/collisions"))
    columns = sorted(whole.columns)
    assert values(good.select(*columns).union(aside.select(*columns))) == values(whole, *columns)
    assert good.filter("speed_limit = 35").count() == 0 and aside.filter("array_contains(broken_rules, 'member:speed_limit')").count() > 0
    report = spark.read.parquet(str(tmp_path / "kept/quality"))
    assert report.filter("table_name = 'collisions' and rule = 'member:speed_limit'").first().violations == aside.filter("speed_limit = 35").count()


def test_distinct_points_add_up_over_years(spark, tmp_path, values):
    from viagrid.plans import annual, measures

    draw = [(p, y, 1 + p % 2) for p in (-40_000, -1, 0, 1, 32_768, 32_769, 2_000_000_000, 7) for y in (2019, 2020, 2021) if (p + y) % 3]
    counts = spark.createDataFrame(draw + [(None, 2019, 1), (7, 2019, 2)], "count_point_id int, year int, region_id int").selectExpr("*", "'Major' as road_type")
    regions = spark.createDataFrame([(1, "A"), (2, "B")], "id int, name string")
    annual.point_bitmaps(counts, regions).write.partitionBy("year").parquet(str(tmp_path / "points"))
    bitmaps = spark.read.parquet(str(tmp_path / "points"))
    named = counts.join(regions.selectExpr("id as region_id", "name as region_name"), "region_id")
    for years in ([2019], [2019, 2021], [2019, 2020, 2021], [1990]):
        for names in (["A"], ["A", "B"]):
            chosen = measures.slice_by(named, years, names)
            found = measures.points_observed(measures.slice_by(bitmaps, years, names))
            assert values(found) == [(chosen.select("count_point_id").distinct().filter("count_point_id is not null").count(),)]
    by = measures.points_observed(bitmaps, ["region_name"])
    assert values(by) == values(named.groupBy("region_name").agg(F.count_distinct("count_point_id")))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, values):
    from viagrid.plans import domain
    from viagrid.sources import catalog

    collisions = spark.createDataFrame(
        [(f"c{k}", 2019 + k % 3, k % 2 == 0, "Slight") for k in range(60)], "collision_id string, collision_year int, is_urban boolean, severity_label string")
    hot = [("c7", n, "car", "17-25", 3, 1600) for n in range(3000)]  # a collision with most of the rows
    vehicles = spark.createDataFrame(
        hot + [(f"c{k % 60}", k, "van" if k % 4 else "car", "26-35", None if k % 5 else 2, k) for k in range(400)],
        "collision_id string, vehicle_reference int, vehicle_type_label string, driver_age_band string, age_of_vehicle int, engine_capacity_cc int")
    casualties = vehicles.selectExpr(
        "collision_id", "'Slight' casualty_severity_label", "vehicle_type_label casualty_type_label", "driver_age_band casualty_age_band", "'Male' sex_label")
    catalog.create_schema(spark, "t_buckets", str(tmp_path / "schema"))
    tables = {"vehicles": vehicles, "casualties": casualties, "collisions": collisions}
    for _ in range(2):  # again replaces them
        kept = domain.store_by_collision(spark, tables, "t_buckets", str(tmp_path / "bucketed"), 4)
    assert kept["collision_vehicles"].filter("collision_id = 'c7'").count() <= 3  # combined before it is bucketed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found, direct in (
            (safety.demographics_from(kept["collision_casualties"], kept["collision_keys"]), safety.casualty_demographics(casualties, collisions)),
            (safety.analysis_from(kept["collision_vehicles"], kept["collision_keys"]), safety.vehicle_analysis(vehicles, collisions)),
        ):
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan[plan.index("SortMergeJoin") :]
            assert "Exchange" in (other := direct._jdf.queryExecution().executedPlan().toString())[other.index("SortMergeJoin") :]
            assert values(found) == values(direct)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_vehicles_and_casualties_are_counted_once_after_the_join(spark, values):
    collisions = spark.createDataFrame(
        [(f"c{k}", 2019 + k % 3, k % 2 == 0, "Slight") for k in range(60)] + [(None, 2019, True, "Slight"), ("c3", 2021, None, "Fatal")],
        "collision_id string, collision_year int, is_urban boolean, severity_label string")
    n = F.col("id")
    vehicles = spark.range(0, 40_000, 1, 8).select(  # a collision with most of the rows; ids without a collision and without a value
        F.when(n % 10 < 8, "c7").when(n % 100 == 9, None).otherwise(F.concat(F.lit("c"), n % 70)).alias("collision_id"),
        F.when(n % 3 == 0, "van").when(n % 3 == 1, "car").alias("vehicle_type_label"), F.concat(F.lit("age "), n % 7).alias("driver_age_band"),
        F.when(n % 3 != 0, n % 20).cast("int").alias("age_of_vehicle"), F.when(n % 4 != 0, n % 3000).cast("int").alias("engine_capacity_cc"))
    casualties = vehicles.selectExpr(
        "collision_id", "'Slight' casualty_severity_label", "vehicle_type_label casualty_type_label", "driver_age_band casualty_age_band", "'Male' sex_label")
    combined = safety.by_collision(vehicles, casualties, collisions)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        for found, before in (
            (safety.casualty_demographics(casualties, collisions), safety.demographics_from(combined["collision_casualties"], collisions)),
            (safety.vehicle_analysis(vehicles, collisions), safety.analysis_from(combined["collision_vehicles"], collisions)),
        ):
            assert found._jdf.queryExecution().executedPlan().toString().count("HashAggregate") == 2  # no counting per collision before the join
            assert values(found) == values(before) and found.columns == before.columns
            assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()  # the hot collision is split
    finally:
        for key in small:
            spark.conf.unset(key)
