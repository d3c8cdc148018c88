import random

import pytest
from pyspark.sql import functions as F

from viagrid.operators import compare, lookup, quality, ranking
from viagrid.operators.keyed import one_per_key


def test_one_row_per_key_is_repeatable_and_null_safe(spark, values):
    rows = [(1, "b", 2), (1, "a", 9), (None, "z", 1), (None, "y", 1), (2, None, 3), (2, "c", 1)]
    df = spark.createDataFrame(rows, "k int, t string, n int")
    kept = one_per_key(df, ["k"])
    assert kept.columns == df.columns
    assert values(kept) == sorted([(1, "a", 9), (None, "y", 1), (2, "c", 1)], key=repr)
    assert values(one_per_key(kept, ["k"])) == values(kept)
    assert values(one_per_key(df.repartition(5), ["k"])) == values(kept)


def test_one_row_per_key_with_a_hot_key(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )
    kept = one_per_key(df, ["k"])
    assert kept.count() == 40_001
    assert kept.filter("k = -1").first().n == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below  # one row per key and task is sent
    assert "SortAggregate" not in plan


def test_one_row_per_key_prefers_values_and_the_latest(spark, values):
    df = spark.createDataFrame([(1, None, None), (1, "A", "x"), (1, "B", None), (2, None, "y")], "k int, a string, b string")
    assert values(one_per_key(df, ["k"])) == [(1, "A", "x"), (2, None, "y")]
    assert values(one_per_key(df, ["k"], ["a"])) == [(1, "B", None), (2, None, "y")]


def test_growth_uses_the_last_period_present(spark, values):
    df = spark.createDataFrame([("a", 2019, 100), ("a", 2021, 110), ("b", 2019, 0), ("b", 2020, 5)], "g string, year int, n int")
    assert values(compare.with_growth(df, "n", ["g"], "p", "c")) == [
        ("a", 2019, 100, None, None), ("a", 2021, 110, 100, 10.0), ("b", 2019, 0, None, None), ("b", 2020, 5, 0, None)]
    strict = compare.with_growth(df, "n", ["g"], "p", "c", strict=True)
    assert ("a", 2021, 110, None, None) in values(strict)


def test_base_value_equals_a_left_join(spark, values):
    rows = [("a", "x", 2019, 10), ("a", "x", 2020, 5), ("b", "x", 2020, 7), (None, "x", 2019, 3), ("a", "y", 2019, 4)]
    df = spark.createDataFrame(rows, "g string, t string, year int, n int")
    ours = df.withColumn("base", compare.base_value("n", ["g", "t"], 2019))
    base = df.filter("year = 2019").select("g", "t", F.col("n").alias("base"))
    assert values(ours, "g", "t", "year", "n", "base") == values(
        df.join(base, ["g", "t"], "left"), "g", "t", "year", "n", "base")


def test_top_ranks_keep_all_ties(spark, values):
    random.seed(7)
    numbers = [None if random.random() < 0.1 else random.randrange(40) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(numbers)), "id int, n int").repartition(8)
    distinct = sorted({n for n in numbers if n is not None}, reverse=True)
    for ranks in (1, 7, 60):
        top = {n: r for r, n in enumerate([*distinct, None][:ranks], start=1)}
        expected = sorted(((i, n, top[n]) for i, n in enumerate(numbers) if n in top), key=repr)
        assert values(ranking.dense_top(df, "n", ranks)) == expected


def test_rank_within_group(spark, values):
    df = spark.createDataFrame([(1, 5), (1, 9), (1, 5), (2, 1)], "g int, n int")
    assert values(ranking.dense_rank_within(df, ["g"], "n", "r")) == [(1, 5, 2), (1, 5, 2), (1, 9, 1), (2, 1, 1)]


def test_slicing_by_dates_does_not_multiply_rows(spark):
    facts = spark.createDataFrame([(2020, 1), (2021, 2)], "year int, n int")
    dates = spark.sql("select explode(sequence(date'2020-01-01', date'2020-12-31', interval 1 day)) d").select(
        F.year("d").alias("year"))
    assert lookup.in_dates(facts, dates).agg(F.sum("n")).first()[0] == 1


def test_missing_years_include_gaps(spark, values):
    source = spark.createDataFrame([(y,) for y in range(2000, 2006)], "year int")
    gold = spark.createDataFrame([(2000,), (2002,), (2003,)], "year int")
    assert values(lookup.missing_from(source, gold, "year")) == [(2001,), (2004,), (2005,)]


def test_point_columns_replace_the_facts_own(spark, values):
    facts = spark.createDataFrame([(1, "old", 3)], "count_point_id int, road_type string, n int")
    points = spark.createDataFrame([(1, "new", "R")], "count_point_id int, road_type string, region_name string")
    assert values(lookup.with_point(facts, points, ["road_type", "region_name"]), "road_type", "n") == [("new", 3)]


@pytest.fixture
def traffic(spark):
    rows = [(1, 2023, "2023-06-15", 51.5074, -0.1278, 150, 20, 30, 220, "London"),
            (2, 2023, "2023-07-20", 53.4808, -2.2426, 200, 35, 10, 270, "North West"),
            (3, 2022, "2022-03-10", 55.9533, -3.1883, 100, 15, 5, 140, "Scotland"),
            (4, 2023, "2023-11-01", 52.4862, -1.8904, 180, 25, 40, 270, "West Midlands"),
            (5, 2021, "2021-09-05", 51.4545, -2.5879, 120, 10, 15, 160, "South West")]
    return spark.createDataFrame(
        rows, "count_point_id int, year int, count_date string, latitude double, longitude double, cars_and_taxis int,"
        " all_hgvs int, pedal_cycles int, total_vehicles int, region_name string").withColumn(
        "count_date", F.col("count_date").cast("date"))


def test_clean_traffic_has_no_violations(traffic):
    rules = {
        "id": quality.absent("count_point_id"), "area": quality.out_of_area(),
        "year": quality.out_of_range("year", 2000, 2025), "cars": quality.negative("cars_and_taxis"),
        "total": quality.below_sum("total_vehicles", ["cars_and_taxis", "all_hgvs", "pedal_cycles"]),
        "name": quality.blank("region_name"), "future": quality.in_future("count_date"),
    }
    report = quality.check_rows(traffic, "traffic", rules)
    assert {(r.violations, r.total) for r in report.collect()} == {(0, 5)}
    assert quality.check_unique(traffic, "traffic", ["count_point_id", "year", "count_date"]).first().violations == 0


def test_broken_rows_are_counted(spark, traffic):
    bad = spark.createDataFrame(
        [(None, 1999, 40.0, 3.0, -1, 9, 9, 1, " ")],
        "count_point_id int, year int, latitude double, longitude double, cars_and_taxis int, all_hgvs int,"
        " pedal_cycles int, total_vehicles int, region_name string")
    rules = {
        "id": quality.absent("count_point_id"), "area": quality.out_of_area(),
        "year": quality.out_of_range("year", 2000, 2025), "cars": quality.negative("cars_and_taxis"),
        "total": quality.below_sum("total_vehicles", ["all_hgvs", "pedal_cycles"]), "name": quality.blank("region_name"),
    }
    both = traffic.drop("count_date").unionByName(bad)
    assert {(r.violations, r.total) for r in quality.check_rows(both, "traffic", rules).collect()} == {(1, 6)}


def test_collision_rules(spark):
    df = spark.createDataFrame(
        [("1", "Fatal", 1, 30), ("2", "Unknown", 0, 35), ("2", "Slight", 2, 70)],
        "collision_id string, severity_label string, number_of_casualties int, speed_limit int")
    report = quality.check_rows(df, "c", {
        "severity": quality.not_member("severity_label", quality.SEVERITIES),
        "speed": quality.not_member("speed_limit", quality.SPEED_LIMITS),
        "casualties": quality.not_positive("number_of_casualties")})
    assert {r.rule: r.violations for r in report.collect()} == {"severity": 1, "speed": 1, "casualties": 1}
    assert quality.check_unique(df, "c", ["collision_id"]).first()[2:] == (1, 2)


def test_coverage_of_regions_and_years(spark, values):
    df = spark.createDataFrame([(name,) for name in quality.REGION_NAMES[:9]], "region_name string")
    assert quality.check_coverage(df, "t", "region_name", quality.REGION_NAMES).first().violations == 2
    assert values(quality.missing_members(df, "region_name", quality.REGION_NAMES)) == [("North East",), ("West Midlands",)]
    assert len(quality.REGION_NAMES) == 11 and len(quality.ENERGY_REGION_IDS) == 17


def test_shares_and_columns(spark):
    mix = spark.createDataFrame(
        [("p", "gas", 60.0), ("p", "wind", 40.0), ("q", "gas", 50.0)], "period_from string, fuel_type string, s double")
    assert quality.check_shares(mix, "t", ["period_from"], "s").first()[2:] == (1, 2)
    report = quality.check_columns(mix, "t", required=["s", "year"], forbidden=["last_page"])
    assert [r.violations for r in report.collect()] == [1, 0]


def test_suites_and_gate(spark, traffic):
    report = quality.suite(traffic, "counts")
    quality.gate(report)
    broken = traffic.withColumn("latitude", F.lit(10.0)) if "latitude" in traffic.columns else traffic.withColumn("pedal_cycles", F.lit(-1))
    with pytest.raises(quality.RuleViolated):
        quality.gate(quality.suite(broken, "counts"))
    events = spark.createDataFrame([("generation_mix", "steam", 120.0, 0)], "event_type string, fuel_type string, fuel_percentage double, region_id int")
    events = events.selectExpr("*", "1.0D as forecast", "1.0D as actual", "'x' as intensity_index", "'r' as region_name")
    found = {r.rule: r.violations for r in quality.suite(events, "events").collect()}
    assert (found["member:fuel_type"], found["percentage_0_100"], found["region_id_from_1"], found["fields:generation_mix"]) == (1, 1, 1, 0)


def test_good_and_rejected_rows_are_the_input(spark, tmp_path, values):
    from viagrid.operators.quarantine import Gate, checked, put_aside

    df = spark.createDataFrame([("1", "a"), ("2", " "), (None, "c"), (None, ""), ("3", None)], "id string, name string")
    with pytest.raises(quality.RuleViolated, match="regions null:id: 2 of 5"):
        checked(spark, df, "regions", Gate(most=0.3), str(tmp_path / "a"))
    found = checked(spark, df, "regions", Gate(most=0.3, shares={"null:id": 0.4, "not_blank:name": 0.4}), str(tmp_path / "b"))
    assert values(found.good) == [("1", "a")]
    assert {(r.id, r.name): r.broken_rules for r in found.rejected.collect()} == {
        ("2", " "): ["not_blank:name"], (None, "c"): ["null:id"], (None, ""): ["null:id", "not_blank:name"], ("3", None): ["null:name"]}
    want = quality.check_rows(df, "regions", quality.rules_of("regions", df.columns))
    assert values(found.report) == values(want)
    plan = found.report._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_rules_broken:bigint>" in plan  # only the mask is read
    put_aside(spark, found, str(tmp_path / "aside"))
    assert spark.read.parquet(str(tmp_path / "aside")).count() == 4
    put_aside(spark, checked(spark, df.limit(1), "regions", Gate(), str(tmp_path / "c")), str(tmp_path / "aside"))
    assert not (tmp_path / "aside").exists()


def test_every_silver_table_has_rules(spark):
    from viagrid.plans import domain

    for table in domain.SILVER_LAYOUT:
        assert quality.UNIQUE_KEYS[table]
        keys = spark.createDataFrame([], ", ".join(f"{k} string" for k in quality.UNIQUE_KEYS[table]))
        assert quality.rules_of(table, keys.columns) and quality.suite(keys, table).count() >= 2
