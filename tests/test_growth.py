"""Work that grows faster than a run's input is kept out of its steps."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from viagrid import session
from viagrid.functions import metrics
from viagrid.functions.cleaning import whole
from viagrid.operators.fingerprint import fingerprints
from viagrid.plans import incremental, silver

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_a_session_built_elsewhere_gets_the_limit_on_methods(spark):
    spark.conf.set(LIMIT, "65535")
    session.short_methods(spark)
    assert spark.conf.get(LIMIT) == "8000"


def test_text_with_a_point_or_a_word_is_not_tried_as_an_int(spark):
    texts = ["837.0", "None", "nan", "12", " 12 ", "1.5e3", "7.8.9", "12.abc", "2147483648", "-5", "", None]
    df = spark.createDataFrame([(text,) for text in texts], "text string").select(whole(F.col("text")).alias("n"))
    assert [row.n for row in df.collect()] == [837, None, None, 12, 12, 1500, None, None, None, -5, None, None]
    assert "contains(" in df._jdf.queryExecution().analyzed().toString().lower()


def test_annual_silver_of_stored_text_is_one_short_method(spark, tmp_path):
    columns = [*silver.ANNUAL_COUNTS, "road_category"]
    spark.range(1).selectExpr(*(f"cast(id as string) as {name}" for name in columns)).write.parquet(str(tmp_path / "raw"))
    plan = silver.annual_counts(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution().executedPlan()
    stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
    sizes = [stages.apply(n)._3().maxMethodCodeSize() for n in range(stages.size())]
    assert sizes and max(sizes) < int(session.DEFAULTS[LIMIT]) - 200  # room for what a write adds


def test_percent_of_rows_has_the_digits_of_percent(spark):
    pairs = [(a, b) for a in (0, 1, -3, 333, 2147483647, None) for b in (0, 1, 7, 200, 20000, 66667, -8, None)]
    df = spark.createDataFrame(pairs, "a int, b int").union(spark.range(5000).selectExpr("int(id)", "20000"))
    wrong = df.filter(~metrics.percent(F.col("a"), F.col("b")).eqNullSafe(metrics.row_percent(F.col("a"), F.col("b"))))
    assert wrong.count() == 0


def test_reference_prints_are_of_tables_computed_once(spark, tmp_path):
    reference = {
        "regions": spark.createDataFrame([("1", " south west"), ("2", "wales ")], "id string, name string"),
        "local_authorities": spark.createDataFrame([("1", "la 1")], "id string, name string"),
        "count_points": spark.createDataFrame([("1", "a1", "51.5", "-0.1")] * 3, "count_point_id string, road_name string, latitude string, longitude string"),
    }
    tidy = incremental.conformed(spark, reference, str(tmp_path / "kept"))
    prints = incremental.reference_prints(tidy)
    assert all(df.inputFiles() for df in tidy.values())
    assert prints == {name: fingerprints(make(reference[name])).first()["fingerprint"] for name, make in incremental.REFERENCE.items()}


def test_print_has_the_exact_sum_of_hashes(spark):
    rows = spark.range(50)
    hashed = rows.select(F.xxhash64(F.lit(1), "id", F.col("id").isNull()).alias("h")).collect()
    found = fingerprints(rows)
    assert found.first()["fingerprint"].split(":")[1] == str(sum(r.h for r in hashed))
    assert "sum(cast(_row" not in found._jdf.queryExecution().analyzed().toString()


def test_unchanged_reference_tables_are_not_written_again(spark, tmp_path, values):
    def reference(point, region="wales "):
        return {
            "regions": spark.createDataFrame([("1", region)], "id string, name string"),
            "local_authorities": spark.createDataFrame([("1", "la 1")], "id string, name string"),
            "count_points": spark.createDataFrame([("1", point, "51.5", "-0.1")] * 2, "count_point_id string, road_name string, latitude string, longitude string"),
        }

    def counts(*years):
        columns = {name: F.lit("1") for name in (*silver.ANNUAL_COUNTS, "road_category")}
        rows = spark.createDataFrame([(str(year),) for year in years], "year string")
        return rows.withColumns({**columns, "year": F.col("year"), "latitude": F.lit("51.5")})

    def files(layer, name):
        return sorted(spark.read.parquet(f"{base}/{layer}/{name}").inputFiles())

    base = str(tmp_path / "base")
    options = {"first_day_year": None}
    incremental.run(spark, counts(2019), reference("a1"), base, **options)
    before = {(layer, name): files(layer, name) for layer in ("bronze", "silver") for name in incremental.REFERENCE}
    assert incremental.run(spark, counts(2019, 2020), reference("a1"), base, **options) == "LOADED"
    assert {key: files(*key) for key in before} == before
    assert incremental.run(spark, counts(2019, 2020), reference("a1"), base, **options) == "NO_NEW_DATA"
    assert incremental.run(spark, counts(2019, 2020), reference("a2"), base, **options) == "LOADED"
    after = {key: files(*key) for key in before}
    assert {name for layer, name in before if after[layer, name] != before[layer, name]} == {"count_points"}
    assert values(spark.read.parquet(f"{base}/silver/count_points"), "road_name") == [("A2",)]
    assert incremental.run(spark, counts(2019, 2020, 2021), reference("a2", "scotland"), base, **options) == "LOADED"
    assert values(spark.read.parquet(f"{base}/bronze/regions"), "name") == [("scotland",)]
    assert values(incremental.gold_table(spark, base, "fact_traffic_summary"), "region_name", "year") == [("Scotland", y) for y in (2019, 2020, 2021)]


def test_jobs_side_by_side_keep_their_order_and_raise_the_first_error(spark):
    met = threading.Barrier(2, timeout=20)

    def job(n):
        met.wait()  # passes if two are under way at once
        return spark.range(n).count()

    assert session.side_by_side(spark, [lambda n=n: job(n) for n in (3, 1, 4, 2)], 2) == [3, 1, 4, 2]
    begun = []

    def failing(n):
        begun.append(n)
        time.sleep(1 / n)
        raise ValueError(n)

    with pytest.raises(ValueError, match="^1$"):
        session.side_by_side(spark, [lambda n=n: failing(n) for n in range(1, 40)], 2)
    assert len(begun) < 39


def test_domain_run_writes_side_by_side_and_reads_its_years_from_silver(spark, tmp_path, values, monkeypatch):
    from checks import standins
    from viagrid.plans import dates, domain
    from viagrid.sources import sinks

    events = spark.range(300).selectExpr(
        "id as event_id", "timestamp'2007-05-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 50 as int)) as ts", "id % 20 as user_id",
        "'view' as event_type", "double(id % 90) as value")
    orders = spark.range(60).selectExpr("id as o_orderkey", "timestamp'2019-05-01 00:00:00' as o_orderdate", "id * 31 as o_custkey", "'1-URGENT' as o_orderpriority")
    lineitem = spark.range(200).selectExpr(
        "id % 70 as l_orderkey", "cast(id as int) as l_linenumber", "id as l_partkey", "id as l_suppkey", "double(id % 50) as l_quantity", "double(id) as l_extendedprice")
    raw = {
        "counts": standins.hourly_raw(events),
        "count_points": standins.hourly_points_raw(spark.range(20).selectExpr("id as c_custkey", "id as c_nationkey", "'BUILDING' as c_mktsegment")),
        "regions": standins.regions_raw(spark.range(3).selectExpr("id as r_regionkey", "'WALES' as r_name")),
        "local_authorities": standins.authorities_raw(spark.range(3).selectExpr("id as n_nationkey", "'LEEDS' as n_name", "id as n_regionkey")),
        "collisions": standins.collisions_raw(orders), "vehicles": standins.vehicles_raw(lineitem), "casualties": standins.casualties_raw(lineitem),
    }

    at, most, lock, write = [0], [0], threading.Lock(), sinks.write_table

    def counted(*args, **options):
        with lock:
            at[0] += 1
            most[0] = max(most[0], at[0])
        try:
            write(*args, **options)
        finally:
            with lock:
                at[0] -= 1

    monkeypatch.setattr(sinks, "write_table", counted)
    seen = []
    paths = domain.run(spark, raw, str(tmp_path), lambda counts: dates.spine_of(seen.append(counts) or counts))
    assert most[0] > 1
    assert all("/silver/counts/" in file for file in seen[0].inputFiles())
    assert values(spark.read.parquet(paths["dim_date"])) == values(dates.date_dim_fiscal(dates.spine_of(silver.hourly_counts(raw["counts"]))))
