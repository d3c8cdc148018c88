import datetime as dt

import pytest
from pyspark.sql import functions as F

from viagrid.functions import calendar, cleaning, labels, metrics
from viagrid.plans import annual

KINDS = "pedal_cycles int, two_wheeled_motor_vehicles int, cars_and_taxis int, buses_and_coaches int, lgvs int, all_hgvs int"


def one(spark, column, ddl="x int", row=(1,)):
    return spark.createDataFrame([row], ddl).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "text, expected",
    [("837", 837), (" 837 ", 837), ("837.0", 837), ("-3", -3), ("12.7", 12), ("None", None), ("nan", None),
     ("", None), (None, None), ("abc", None), ("99999999999", None)],
)
def test_whole_numbers_from_text(spark, text, expected):
    assert one(spark, cleaning.whole(F.col("x")), "x string", (text,)) == expected


@pytest.mark.parametrize("text, expected", [("51.5", 51.5), ("nan", None), ("None", None), ("-0.1278", -0.1278)])
def test_reals_from_text(spark, text, expected):
    assert one(spark, cleaning.real(F.col("x")), "x string", (text,)) == expected


def test_text_rules(spark):
    assert one(spark, cleaning.capitals(F.col("x")), "x string", (" a3111 ",)) == "A3111"
    assert one(spark, cleaning.title_case(F.col("x")), "x string", (" east of england",)) == "East Of England"
    assert one(spark, cleaning.day("dd/MM/yyyy")(F.col("x")), "x string", ("15/01/2023",)) == dt.date(2023, 1, 15)
    assert one(spark, cleaning.day("dd/MM/yyyy")(F.col("x")), "x string", ("2023-01-15",)) is None


@pytest.mark.parametrize(
    "latitude, longitude, inside",
    [(49.0, -8.0, True), (61.0, 2.0, True), (48.9, 0.0, False), (61.1, 0.0, False), (50.0, -8.1, False),
     (50.0, 2.1, False), (float("nan"), 0.0, False)],
)
def test_area_includes_its_ends(spark, latitude, longitude, inside):
    df = spark.createDataFrame([(latitude, longitude)], "latitude double, longitude double")
    assert df.filter(cleaning.within_area()).count() == int(inside)


def test_expected_figures(spark):
    row = (105, 87, 837, 25, 451, 30)
    assert one(spark, metrics.total_vehicles(), KINDS, row) == 1535
    assert one(spark, metrics.percent(F.lit(30), F.lit(1430))) == 2.1
    assert one(spark, metrics.percent(F.lit(105 + 25), F.lit(1535))) == 8.47
    assert one(spark, metrics.growth_percent(F.lit(110), F.lit(100))) == 10.0
    assert one(spark, metrics.growth_percent(F.lit(76), F.lit(100))) == -24.0
    assert one(spark, metrics.percent(F.lit(90680), F.lit(100000))) == 90.68
    assert one(spark, metrics.change(F.lit(160.0), F.lit(178.0))) == -18
    assert one(spark, metrics.percent(F.lit(1), F.lit(0))) is None


def test_total_is_null_if_a_part_is(spark):
    assert one(spark, metrics.total_vehicles(), KINDS, (1, 1, None, 1, 1, 1)) is None


@pytest.mark.parametrize(
    "kind, n, kg", [("cars_and_taxis", 100, 209.92), ("all_hgvs", 50, 375.04), ("pedal_cycles", 500, 0.0)]
)
def test_co2_of_examples(spark, kind, n, kg):
    assert one(spark, metrics.co2_kg(kind), f"{kind} int", (n,)) == kg


def test_co2_equals_the_rounded_formula(spark):
    counts = spark.range(0, 300_000, 7).select(
        *(F.col("id").cast("int").alias(kind) for kind in metrics.VEHICLE_KINDS)
    )
    for kind, grams in metrics.GRAMS_PER_KM.items():
        direct = F.round(F.col(kind) * F.lit(grams) * F.lit(metrics.TRIP_KM) / 1000, 2)
        assert counts.filter(metrics.co2_kg(kind) != direct).count() == 0


def test_exact_sum_ignores_order_and_nulls(spark):
    df = spark.createDataFrame([(22.7,), (23.4,), (0.5,), (None,)], "x double")
    assert df.agg(metrics.exact_sum(F.col("x"), 6).alias("v")).first().v == 46.6
    assert df.repartition(3).agg(metrics.exact_mean(F.col("x"), 2).alias("v")).first().v == pytest.approx(46.6 / 3)
    assert df.limit(0).agg(metrics.exact_mean(F.col("x"), 2).alias("v")).first().v is None


@pytest.mark.parametrize(
    "rule, value, label",
    [
        (labels.intensity_category, 30, "Very Low"), (labels.intensity_category, 160, "Moderate"),
        (labels.intensity_category, 350, "Very High"), (labels.intensity_category, None, "Very High"),
        (labels.count_period, 9, "morning_peak"), (labels.count_period, None, "night"),
        (labels.collision_period, 23, "Night"), (labels.severity, 2, "Serious"), (labels.severity, None, "Unknown"),
        (labels.is_urban, None, False), (labels.is_urban, 1, True), (labels.light, 2, "Unknown"),
        (labels.weather, 8, "Other/Unknown"), (labels.vehicle_type, 20, "Goods vehicle"),
        (labels.driver_age_band, 16, "Unknown"), (labels.driver_age_band, 66, "65+"),
        (labels.casualty_age_band, 0, "0-15"), (labels.casualty_type, 23, "Motorcyclist"), (labels.sex, 3, "Unknown"),
        (labels.speed_band, None, "70+ mph"), (labels.risk_category, 200, "Medium"),
    ],
)
def test_labels_of_codes(spark, rule, value, label):
    assert one(spark, rule(F.col("x")), "x int", (value,)) == label


@pytest.mark.parametrize(
    "rule, value, label",
    [
        (labels.energy_category, "wind", "Renewable"), (labels.energy_category, "coal", "Fossil Fuel"),
        (labels.energy_category, None, "Other"), (labels.road_class, "TM", "Motorway/Trunk A"),
        (labels.road_class, None, "Minor/B Road"), (labels.road_category, "Minor", "B Road / Minor"),
        (labels.period_sort_order, "evening", 4), (labels.period_sort_order, None, 5),
    ],
)
def test_labels_of_text(spark, rule, value, label):
    assert one(spark, rule(F.col("x")), "x string", (value,)) == label


@pytest.mark.parametrize(
    "rule, value, label",
    [
        (labels.congestion_level, 0.9, "Severely Congested"), (labels.congestion_level, None, "Free Flow"),
        (labels.sustainability_tier, 5.0, "Progressing"), (labels.emission_category, 2.5, "Medium Emission"),
    ],
)
def test_labels_of_measures(spark, rule, value, label):
    assert one(spark, rule(F.col("x")), "x double", (value,)) == label


def test_missing_values_can_be_told_apart(spark):
    assert one(spark, labels.congestion_level(F.col("x"), "No data"), "x double", (None,)) == "No data"


@pytest.mark.parametrize(
    "text, hour", [("17:05", 17), ("7:05", 7), ("00:00", 0), ("24:00", None), ("17:75", None), ("x", None), (None, None)]
)
def test_hour_of_time_text(spark, text, hour):
    assert one(spark, calendar.clock_hour(F.col("x")), "x string", (text,)) == hour


@pytest.mark.parametrize(
    "date, year, quarter", [("2024-03-31", 2023, 4), ("2024-04-01", 2024, 1), ("2024-12-31", 2024, 3), ("2024-05-31", 2024, 1)]
)
def test_fiscal_periods(spark, date, year, quarter):
    df = spark.createDataFrame([(dt.date.fromisoformat(date),)], "d date")
    assert tuple(df.select(calendar.fiscal_year(F.col("d")), calendar.fiscal_quarter(F.col("d"))).first()) == (year, quarter)


def test_text_is_a_whole_number_or_nothing(spark):
    texts = ["837.0", "12.abc", "7.8.9", "1.5e3", "1.2345678E7", ".5", "-3", " 4 ", "nan", "None", "Infinity", "2147483648", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    found = [r[0] for r in df.select(cleaning.whole(F.col("x"))).collect()]
    assert found == [837, None, None, 1500, 12345678, 0, -3, 4, None, None, None, None, None, None]


def test_dirty_values_stop_no_job(spark):
    df = spark.createDataFrame([(2**31 - 1, "Infinity"), (1, "1e300"), (2, "-Infinity"), (3, "nan"), (4, "2.5")], "n int, x string")
    total = df.select(metrics.added(["n", "n"]).alias("s")).agg(F.max("s")).first()[0]
    assert total == 2 * (2**31 - 1)
    reals = df.select(cleaning.real(F.col("x")).alias("x"))
    assert sorted(r.x for r in reals.dropna().collect()) == [2.5, 1e300]
    assert reals.agg(metrics.exact_mean(F.col("x"), 6)).first()[0] == 2.5


def test_units_are_summed_in_two_halves_without_a_decimal_per_row(spark):
    values = [(0.07,), (-12.34,), (None,), (float("nan"),), (float("inf"),), (9.1e15,), (1234567890123456.7,), (-9.9e15,), (4e16,), (-0.0,)]
    df = spark.createDataFrame(values, "x double")
    old = metrics.as_units(F.col("x"), 2)
    assert df.filter(~old.cast("bigint").eqNullSafe(metrics.long_units(F.col("x"), 2))).count() == 0
    row = df.agg(metrics.exact_sum(F.col("x"), 2).alias("a"), (F.sum(old).cast("double") / 100.0).alias("b")).first()
    assert row.a == row.b


def test_totals_from_bitmaps_are_the_regional_totals(spark, values):
    kinds = ", ".join(f"{name} int" for name in metrics.VEHICLE_KINDS)
    schema = f"count_point_id int, year int, region_id int, road_type string, {kinds}, all_motor_vehicles int, total_vehicles long, hgv_percentage double"
    rows = [(p, 2019 + p % 2, 1 + r, road, 1, 2, 3, 4, 5, n, 6, 21, n / 7 if n else None)
            for p, r, road, n in [(1, 0, "Major", 3), (1, 1, "Major", 4), (1, 1, "Major", 0), (2, 0, None, 5), (-1, 2, "Minor", 6), (0, 3, "Minor", 7), (40000, 0, "Major", 8)]]
    counts = spark.createDataFrame([*rows, (None, 2019, 1, "Lone", *rows[0][4:])], schema)
    regions = spark.createDataFrame([(1, "A"), (2, "A"), (3, None)], "id int, name string")
    whole = annual.regional_totals(counts, regions)
    made = annual.totals_with_points(counts, regions, annual.point_bitmaps(counts, regions))
    assert made.columns == whole.columns and [f.dataType for f in made.schema] == [f.dataType for f in whole.schema]
    assert values(made) == values(whole) and len(values(whole)) == 5
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "distinct" not in plan and "region_id" in plan
