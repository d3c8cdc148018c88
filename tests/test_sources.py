import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from viagrid import schemas
from viagrid.plans import annual, incremental, serving, silver
from viagrid.session import work_folder
from viagrid.sources import catalog, landed, sinks

RECORD = "count_point_id int, year int, cars_and_taxis int"


def test_paged_envelopes_in_whole_files(spark, tmp_path, values):
    for page, data in ((1, [(51, 2000, 837)]), (2, [(51, 2001, 857)]), (3, [])):
        body = {"current_page": page, "last_page": 4, "total": 2, "per_page": 1,
                "data": [dict(zip(("count_point_id", "year", "cars_and_taxis"), row)) for row in data]}
        (tmp_path / f"{page}.json").write_text(json.dumps(body, indent=2))
    pages = landed.read_pages(spark, str(tmp_path), RECORD, whole_files=True)
    assert values(landed.page_records(pages)) == [(51, 2000, 837), (51, 2001, 857)]
    assert landed.page_records(pages).columns == ["count_point_id", "year", "cars_and_taxis"]
    gaps = landed.page_gaps(pages, ["per_page"]).first()
    assert (gaps.pages_read, gaps.pages_announced, gaps.records, gaps.complete) == (3, 4, 2, False)


def test_rows_envelope_and_plain_list(spark, tmp_path, values):
    (tmp_path / "a.json").write_text('{"rows": [{"id": 1, "name": "x"},\n {"id": 2}]}')
    assert values(landed.read_rows(spark, str(tmp_path), "id int, name string", whole_files=True)) == [(1, "x"), (2, None)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b/list.json").write_text('[{"id": 1, "name": "x"},\n {"id": 2, "name": "y"}]')
    assert values(landed.read_list(spark, str(tmp_path / "b"), "id int, name string", True)) == [(1, "x"), (2, "y")]
    with pytest.raises(Exception, match="MALFORMED"):
        landed.read_list(spark, str(tmp_path / "b"), "id int, name string").collect()


def test_mixed_json_as_text_keeps_nulls(spark, tmp_path, values):
    (tmp_path / "a.json").write_text('[{"id": 1, "n": null}, {"id": "b", "n": 2.5}]')
    assert values(landed.read_as_text(spark, str(tmp_path)), "id", "n") == [("1", None), ("b", "2.5")]


def test_contract_as_text():
    assert schemas.as_text("id int, name string, x double") == "id string, name string, x string"


@pytest.mark.parametrize("escape, quoted", [('"', 'a ""b"", c'), ("\\", 'a \\"b\\", c')])
def test_csv_dialects(spark, tmp_path, escape, quoted):
    names = [part.split()[0] for part in schemas.COLLISIONS.split(", ")]
    path = tmp_path / "c.csv"
    path.write_text(",".join(names) + f'\n0017,15/01/2023,"{quoted}\nd",51.5,-0.1,1,2,30,1,1,1,1\n')
    row = landed.read_csv(spark, str(path), schemas.COLLISIONS, escape=escape, multi_line=True).first()
    assert (row.accident_index, row.time, row.speed_limit) == ("0017", 'a "b", c\nd', 30)


def test_overwrite_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([(1, 2)], "a int, b int"), path)
    sinks.write_table(spark.createDataFrame([("x",)], "c string"), path)
    assert spark.read.parquet(path).columns == ["c"]


def test_only_the_partitions_present_are_replaced(spark, tmp_path, values):
    path = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([(1, 2000), (2, 2001)], "a int, y int"), path, ["y"])
    for _ in range(2):
        fresh = spark.createDataFrame([(9, 2001), (8, 2002)], "a int, y int")
        sinks.write_table(fresh, path, ["y"], replace_only_present=True)
    assert values(spark.read.parquet(path), "a", "y") == [(1, 2000), (8, 2002), (9, 2001)]


def test_partition_by_copy_keeps_the_column_in_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_by_copy(spark.createDataFrame([(1, 2000)], "a int, year int"), path, "year")
    assert spark.read.option("recursiveFileLookup", True).parquet(path).columns == ["a", "year"]


def test_landing_folder_and_provenance(spark, tmp_path):
    df = sinks.with_lineage(spark.range(3), "feed")
    path = sinks.land(df, str(tmp_path), "counts", dt.date(2024, 3, 9))
    assert path.endswith("/counts/2024/03/09") and list((tmp_path / "counts/2024/03/09").glob("*.snappy.parquet"))
    assert spark.read.parquet(path).columns == ["id", "_ingestion_timestamp", "_ingestion_date", "_source"]


def test_catalog_registration_audit_and_statistics(spark, tmp_path, values):
    plain, parted = str(tmp_path / "plain"), str(tmp_path / "parted")
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "a int, year int")
    sinks.write_table(df, plain)
    sinks.write_table(df, parted, ["year"])
    catalog.create_schema(spark, "t_cat", str(tmp_path / "schema"))
    for _ in range(2):
        catalog.register(spark, "t_cat", {"plain": plain, "parted": parted})
    assert values(catalog.audit(spark, "t_cat"), "table_name", "row_count", "table_type") == [
        ("parted", 2, "EXTERNAL"), ("plain", 2, "EXTERNAL")]
    assert values(catalog.refresh_statistics(spark, "t_cat"), "table_name", "status") == [
        ("parted", "updated"), ("plain", "updated")]


def test_statistics_go_on_past_a_failure(spark, tmp_path, values):
    for name in ("gone", "kept"):
        sinks.write_table(spark.range(2), str(tmp_path / name))
    catalog.create_schema(spark, "t_bad", str(tmp_path / "schema"))
    catalog.register(spark, "t_bad", {name: str(tmp_path / name) for name in ("gone", "kept")})
    for file in (tmp_path / "gone").glob("*.parquet"):
        file.write_bytes(b"no parquet")
    report = {r.table_name: r for r in catalog.refresh_statistics(spark, "t_bad").collect()}
    assert report["kept"].status == "updated" and report["gone"].status == "failed" and report["gone"].message


def test_work_folder_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second


def raw_counts(spark, years):
    rows = [(str(p), str(y), str(1 + p % 2), str(p % 3), f" a{p} ", "PA", "Major ", "51.5", "-0.1", "1.5",
             str(p), "1", f"{100 + y % 7 + p}.0", "2", "3", "None" if p == 5 else "4", "110")
            for p in range(12) for y in years]
    return spark.createDataFrame(
        rows, "count_point_id string, year string, region_id string, local_authority_id string, road_name string,"
        " road_category string, road_type string, latitude string, longitude string, link_length_km string,"
        " pedal_cycles string, two_wheeled_motor_vehicles string, cars_and_taxis string, buses_and_coaches string,"
        " lgvs string, all_hgvs string, all_motor_vehicles string")


def test_incremental_equals_full_and_repeats_change_nothing(spark, tmp_path, values):
    reference = {
        "regions": spark.createDataFrame([("1", " south west"), ("2", "wales ")], "id string, name string"),
        "local_authorities": spark.createDataFrame([(str(i), f"la {i}") for i in range(3)], "id string, name string"),
        "count_points": raw_counts(spark, [2019]).select("count_point_id", "road_name", "latitude", "longitude"),
    }
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    assert incremental.run(spark, raw_counts(spark, [2019, 2021]), reference, step) == "LOADED"
    years = [2019, 2020, 2021, 2022]
    assert incremental.run(spark, raw_counts(spark, years), reference, step) == "LOADED"
    assert incremental.run(spark, raw_counts(spark, years), reference, step) == "NO_NEW_DATA"
    assert incremental.run(spark, raw_counts(spark, years), reference, whole) == "LOADED"
    for name in serving.BATCH_VIEWS.values():
        ours, full = (incremental.gold_table(spark, base, name) for base in (step, whole))
        assert values(ours, *sorted(ours.columns)) == values(full, *sorted(ours.columns)), name
        assert full.count() > 0
    assert spark.read.parquet(f"{step}/bronze/counts").count() == 48
    assert "year" in incremental.gold_table(spark, step, "fact_traffic_summary").columns
    views = serving.folder_views(spark, incremental.gold_path(spark, whole, ""), serving.BATCH_VIEWS)
    assert {r.view_name for r in sinks.row_counts(views).collect()} == set(serving.BATCH_VIEWS)


def test_shares_of_a_mix_and_sums_are_kept(spark):
    counts = silver.annual_counts(raw_counts(spark, [2019, 2020]))
    regions = silver.named_areas(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string"))
    summary = annual.traffic_summary(counts, regions)
    assert summary.agg(F.sum("total_all_vehicles")).first()[0] == counts.agg(F.sum("total_vehicles")).first()[0]
    assert silver.annual_counts(raw_counts(spark, [2019])).filter("all_hgvs is null").first().total_vehicles is None


def test_year_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "silver")
    sinks.write_table(silver.annual_counts(raw_counts(spark, [2019, 2020])), path, sort_by=["year"])
    regions = silver.named_areas(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string"))
    counts = spark.read.parquet(path)
    busiest = annual.busiest_roads(counts, regions, 2020)
    plan = busiest._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(year,2020)" in plan and "CartesianProduct" not in plan
    assert all("lgvs" not in line for line in plan.splitlines() if line.startswith("ReadSchema"))
    impact = annual.covid_impact(counts, regions, 2019, 2020)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(year,2019)" in impact and impact.count("FileScan parquet") == 1
    assert "count_point_id" not in impact


def test_gold_on_stored_totals_reads_the_counts_once(spark, tmp_path):
    counts = silver.annual_counts(raw_counts(spark, [2019, 2020]))
    regions = silver.named_areas(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string"))
    sinks.write_table(annual.regional_totals(counts, regions), str(tmp_path / "totals"))
    totals = spark.read.parquet(str(tmp_path / "totals"))
    assert sorted(annual.mix_from(totals).collect()) == sorted(annual.vehicle_mix(counts, regions).collect())
    assert sorted(annual.co2_from(totals).collect()) == sorted(annual.co2_emissions(counts, regions).collect())


def test_only_the_loaded_years_are_read(spark, tmp_path, monkeypatch):
    """The second run reads silver counts of its own years for all tables but the date span and the last year's roads."""
    reference = {
        "regions": spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string"),
        "local_authorities": spark.createDataFrame([(str(i), f"la {i}") for i in range(3)], "id string, name string"),
        "count_points": raw_counts(spark, [2019]).select("count_point_id", "road_name", "latitude", "longitude"),
    }
    base, plans, files = str(tmp_path), {}, {}
    written = sinks.write_table

    def watched(df, path, *args, **options):
        files[path] = df.inputFiles()
        plans[path] = df._jdf.queryExecution().executedPlan().toString()
        written(df, path, *args, **options)

    incremental.run(spark, raw_counts(spark, [2019, 2020]), reference, base)
    monkeypatch.setattr(sinks, "write_table", watched)
    incremental.run(spark, raw_counts(spark, [2019, 2020, 2021]), reference, base)
    for name in ("totals", "road_analysis", "locations"):
        plan = plans[f"{base}/yearly/{name}"]
        assert "PartitionFilters: [isnotnull(year" in plan and "= 2021)" in plan
    bronze = plans[f"{base}/silver/counts"]
    assert "= 2021)" in bronze and "PartitionFilters: [isnotnull(load_year" in bronze
    for name in ("fact_traffic_summary", "fact_road_analysis", "dim_location"):
        read = next(names for path, names in files.items() if path.endswith(f"/{name}"))
        assert read and all("/yearly/" in file for file in read), name


def test_a_run_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    reference = {
        "regions": spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string"),
        "local_authorities": spark.createDataFrame([("0", "la")], "id string, name string"),
        "count_points": raw_counts(spark, [2019]).select("count_point_id", "road_name", "latitude", "longitude"),
    }
    base = str(tmp_path)
    assert incremental.run(spark, raw_counts(spark, [2019]), reference, base) == "LOADED"
    with monkeypatch.context() as patch:
        patch.setattr(annual, "mix_from", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.run(spark, raw_counts(spark, [2019, 2020]), reference, base)
    assert incremental.gold_table(spark, base, "fact_traffic_summary").agg(F.max("year")).first()[0] == 2019
    assert incremental.run(spark, raw_counts(spark, [2019, 2020]), reference, base) == "LOADED"
    for name in ("fact_traffic_summary", "fact_vehicle_mix", "fact_road_analysis"):
        assert incremental.gold_table(spark, base, name).agg(F.max("year")).first()[0] == 2020
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert not [name for name in os.listdir(shared) if name.startswith("road-totals")]


def test_a_renamed_region_is_renamed_in_all_years(spark, tmp_path):
    def reference(name):
        return {
            "regions": spark.createDataFrame([("1", name), ("2", "b")], "id string, name string"),
            "local_authorities": spark.createDataFrame([("0", "la")], "id string, name string"),
            "count_points": raw_counts(spark, [2019]).select("count_point_id", "road_name", "latitude", "longitude"),
        }

    base = str(tmp_path)
    incremental.run(spark, raw_counts(spark, [2019]), reference("old"), base)
    incremental.run(spark, raw_counts(spark, [2019, 2020]), reference("new"), base)
    names = incremental.gold_table(spark, base, "fact_traffic_summary").select("region_name", "year").distinct().collect()
    assert {tuple(r) for r in names} == {("New", 2019), ("New", 2020), ("B", 2019), ("B", 2020)}


def areas(spark, region="a", authority="la"):
    return {
        "regions": spark.createDataFrame([("1", region), ("2", "b")], "id string, name string"),
        "local_authorities": spark.createDataFrame([("0", authority)], "id string, name string"),
        "count_points": raw_counts(spark, [2019]).select("count_point_id", "road_name", "latitude", "longitude"),
    }


def gold_of(spark, base, values):
    return {name: values(incremental.gold_table(spark, base, name)) for name in ("fact_traffic_summary", "fact_road_analysis", "dim_location", "fact_busiest_roads")}


def broken_off(patch, step, *args, **options):
    with patch.context() as broken:
        broken.setattr(annual, step, lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.run(*args, **options)


def test_a_rename_in_a_run_that_breaks_off_reaches_all_years(spark, tmp_path, values, monkeypatch):
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    both = raw_counts(spark, [2019, 2020])
    incremental.run(spark, raw_counts(spark, [2019]), areas(spark, "old"), step)
    broken_off(monkeypatch, "impact_from", spark, both, areas(spark, "new"), step)
    assert incremental.run(spark, both, areas(spark, "new"), step) == "LOADED"
    incremental.run(spark, both, areas(spark, "new"), whole)
    assert gold_of(spark, step, values) == gold_of(spark, whole, values)


def test_a_rename_that_is_taken_back_leaves_no_year_behind(spark, tmp_path, values, monkeypatch):
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    both = raw_counts(spark, [2019, 2020])
    incremental.run(spark, raw_counts(spark, [2019]), areas(spark, "old"), step)
    broken_off(monkeypatch, "impact_from", spark, both, areas(spark, "new"), step)
    assert incremental.run(spark, both, areas(spark, "old"), step) == "LOADED"
    incremental.run(spark, both, areas(spark, "old"), whole)
    assert gold_of(spark, step, values) == gold_of(spark, whole, values)
    assert incremental.run(spark, both, areas(spark, "old"), step) == "NO_NEW_DATA"


def test_changed_names_and_corrected_years_are_found(spark, tmp_path, values, monkeypatch):
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    years = raw_counts(spark, [2019, 2020, 2021])
    wrong = years.withColumn("lgvs", F.when(F.col("year") == "2020", "9999").otherwise(F.col("lgvs")))
    incremental.run(spark, wrong, areas(spark), step)
    assert incremental.run(spark, years.repartition(3), areas(spark), step) == "NO_NEW_DATA"  # loaded years are not read again
    broken_off(monkeypatch, "impact_from", spark, years, areas(spark), step, recheck=True)
    assert incremental.run(spark, years, areas(spark), step) == "LOADED"  # what broke off is done again
    assert incremental.run(spark, years.repartition(3), areas(spark), step, recheck=True) == "NO_NEW_DATA"
    incremental.run(spark, years, areas(spark), whole)
    assert gold_of(spark, step, values) == gold_of(spark, whole, values)
    assert incremental.run(spark, years, areas(spark, authority="renamed"), step) == "LOADED"  # without a new year
    incremental.run(spark, years, areas(spark, authority="renamed"), f"{whole}2")
    assert gold_of(spark, step, values) == gold_of(spark, f"{whole}2", values)


def test_a_corrected_year_without_usable_rows_goes(spark, tmp_path, values):
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    years = raw_counts(spark, [2019, 2020])
    unusable = years.withColumn("latitude", F.when(F.col("year") == "2020", "0").otherwise(F.col("latitude")))
    incremental.run(spark, years, areas(spark), step)
    assert incremental.run(spark, unusable, areas(spark), step, recheck=True) == "LOADED"
    incremental.run(spark, unusable, areas(spark), whole)
    assert gold_of(spark, step, values) == gold_of(spark, whole, values)
    points = areas(spark)["count_points"].withColumn("road_name", F.lit("renamed"))
    assert incremental.run(spark, unusable, {**areas(spark), "count_points": points}, step) == "LOADED"
    assert gold_of(spark, step, values) == gold_of(spark, whole, values)
    assert {r[0] for r in spark.read.parquet(f"{step}/silver/count_points").select("road_name").collect()} == {"RENAMED"}


def test_fingerprints_see_rows_not_their_order(spark):
    from viagrid.operators.fingerprint import fingerprints

    def print_of(rows, kind="a string, b string"):
        return fingerprints(spark.createDataFrame(rows, kind)).first()[0]

    rows = [("x", None), (None, "x"), ("x", "y"), ("x", "y")]
    assert print_of(rows) == print_of(rows[::-1]) == print_of([(b, a) for a, b in rows], "b string, a string")
    others = [rows[:3], [("x", None), ("x", None), ("x", "y"), ("x", "y")], [(None, "x")] + rows[1:], []]
    assert len({print_of(rows), *map(print_of, others)}) == 5
    assert {r.a: r.fingerprint for r in fingerprints(spark.createDataFrame(rows, "a string, b string"), ["a"]).collect()}.keys() == {"x", None}


def landed_text(folder, *files):
    folder.mkdir()
    for n, text in enumerate(files):
        (folder / f"{n}.json").write_text(text)
        os.utime(folder / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def page(region, number, last, *ids):
    return json.dumps({"region": region, "current_page": number, "last_page": last, "data": [{"id": i} for i in ids]}) + "\n"


def test_of_a_page_landed_twice_the_later_counts(spark, tmp_path, values):
    from viagrid.plans import raw

    old = page(1, 1, 2, 90, 91) + page(1, 2, 2, 20) + page(2, 1, 1, 30)
    path = landed_text(tmp_path / "pages", old, page(1, 1, 2, 10) + page(None, 1, 1, 40), page(1, 2, 2, 20) * 2)
    feed = raw.Feed(path, "id int", "pages", by="region int")
    assert values(feed.read(spark)) == [(10,), (20,), (30,), (40,)]
    assert feed.gaps(spark).count() == 0
    whole = raw.Feed(path, "id int", "pages", by="region int", whole_files=False, asked=spark.createDataFrame([(1,), (2,), (3,)], "region int"))
    assert [(r.region, r.pages_read) for r in whole.gaps(spark).collect()] == [(3, 0)]
    with pytest.raises(raw.IncompleteFeed):
        raw.run(spark, {"counts": whole}, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_pages_without_repeats_are_not_shuffled_with_their_records(spark, tmp_path):
    path = landed_text(tmp_path / "pages", page(1, 1, 1, 10))
    pages = landed.read_pages(spark, path, "id int", extra="region int")
    found = landed.newest_pages(pages, ["region"])
    assert found.count() == 1 and found.columns == pages.columns
    assert "cartesian" not in found._jdf.queryExecution().executedPlan().toString().lower()


def test_bad_lines_are_kept_beside_the_table(spark, tmp_path, values):
    from viagrid.plans import raw

    good = "".join(json.dumps({"id": n, "name": "x"}) + "\n" for n in range(997))
    path = landed_text(tmp_path / "list", good + '{"id": 1, "na\n{"id": "one", "name": "y"}\nnothing\n')
    report = raw.run(spark, {"names": raw.Feed(path, "id int, name string", bad_share=0.003)}, str(tmp_path / "out"))
    assert values(report, "table_name", "row_count") == [("names", 997), ("names_bad_lines", 3)]
    beside = spark.read.parquet(str(tmp_path / "out/names_bad_lines"))
    assert {r.line: r.read_as for r in beside.collect()}['{"id": "one", "name": "y"}'] == '{"name":"y"}'
    assert all(r.file.endswith("/0.json") for r in beside.collect())
    with pytest.raises(raw.UnreadableFeed):
        raw.run(spark, {"names": raw.Feed(path, "id int, name string", bad_share=0.002)}, str(tmp_path / "refused"))
    assert not (tmp_path / "refused").exists()
    clean = landed_text(tmp_path / "clean", good)
    report = raw.run(spark, {"names": raw.Feed(clean, "id int, name string")}, str(tmp_path / "out"))
    assert values(report, "table_name", "row_count") == [("names", 997)] and not (tmp_path / "out/names_bad_lines").exists()


def test_a_broken_whole_file_is_counted(spark, tmp_path):
    from viagrid.plans import raw

    path = landed_text(tmp_path / "rows", '{"rows": [{"id": 1},\n {"id": 2}]}', '{"rows": [{"id": 3},\n')
    feed = raw.Feed(path, "id int", "rows", whole_files=True)
    assert landed.line_counts(spark, path, feed.documents, True) == (2, 1)
    with pytest.raises(raw.UnreadableFeed):
        raw.run(spark, {"rows": feed}, str(tmp_path / "out"))


def test_a_gate_in_incremental_runs(spark, tmp_path, values):
    from viagrid.operators.quality import RuleViolated
    from viagrid.operators.quarantine import Gate

    base = str(tmp_path / "step")
    years = raw_counts(spark, [2019, 2020])
    odd = years.withColumn("lgvs", F.lit("1")).withColumn("pedal_cycles", F.when((F.col("year") == "2020") & (F.col("count_point_id") == "3"), "-4").otherwise("1"))
    gate = Gate(most=0.2)
    assert incremental.run(spark, odd.filter("year = '2019'"), areas(spark), base, gate=gate) == "LOADED"
    with pytest.raises(RuleViolated):
        incremental.run(spark, odd, areas(spark), base, gate=Gate(most=0.01))
    assert {r.year for r in incremental.gold_table(spark, base, "fact_traffic_summary").collect()} == {2019}
    assert incremental.run(spark, odd, areas(spark), base, gate=gate) == "LOADED"
    silver_rows, aside = spark.read.parquet(f"{base}/silver/counts"), spark.read.parquet(f"{base}/quarantine/counts")
    assert silver_rows.count() + aside.count() == 24 and [(r.year, r.broken_rules) for r in aside.collect()] == [(2020, ["not_negative:pedal_cycles"])]
    assert incremental.run(spark, odd, areas(spark), base, gate=gate) == "NO_NEW_DATA"
    mended = odd.withColumn("pedal_cycles", F.lit("1"))
    assert incremental.run(spark, mended, areas(spark), base, recheck=True, gate=gate) == "LOADED"
    assert spark.read.parquet(f"{base}/silver/counts").count() == 24 and not os.path.exists(f"{base}/quarantine/counts/year=2020")


def test_years_of_a_partitioned_source_come_from_its_folders(spark, tmp_path, values):
    source, step, whole = (str(tmp_path / n) for n in ("source", "step", "whole"))
    years = raw_counts(spark, [2019, 2020, 2021])
    years.filter("year < '2021'").write.partitionBy("year").parquet(source)
    assert incremental.run(spark, source, areas(spark), step) == "LOADED"
    for folder in ("year=2019", "year=2020"):  # what is loaded is not opened again
        for name in os.listdir(f"{source}/{folder}"):
            os.remove(f"{source}/{folder}/{name}")
        with open(f"{source}/{folder}/part-0.parquet", "w") as file:
            file.write("no parquet")
    assert incremental.run(spark, source, areas(spark), step) == "NO_NEW_DATA"
    years.filter("year = '2021'").write.partitionBy("year").mode("append").parquet(source)
    assert incremental.run(spark, source, areas(spark), step) == "LOADED"
    incremental.run(spark, years, areas(spark), whole)
    assert gold_of(spark, step, values) == gold_of(spark, whole, values)
    flat = str(tmp_path / "flat")
    years.write.parquet(flat)
    assert incremental.run(spark, flat, areas(spark), step) == "NO_NEW_DATA"


def test_only_loaded_partitions_are_analysed(spark, tmp_path):
    path = str(tmp_path / "parted")
    sinks.write_table(spark.createDataFrame([(n, 2000 + n % 3) for n in range(30)], "a int, year int"), path, ["year"])
    catalog.create_schema(spark, "t_parts", str(tmp_path / "schema"))
    catalog.register(spark, "t_parts", {"counts": path})
    assert catalog.refresh_partitions(spark, "t_parts.counts", "year") == (3, 30)
    sinks.write_table(spark.createDataFrame([(n, 2003) for n in range(7)] + [(1, 2001)], "a int, year int"), path, ["year"], replace_only_present=True)
    assert catalog.refresh_partitions(spark, "t_parts.counts", "year", [2001, 2003]) == (2, 28)
    assert catalog.refresh_partitions(spark, "t_parts.counts", "year") == (0, 28)
    assert catalog.refresh_partitions(spark, "t_parts.counts", "year", [2000, 2001, 2002, 2003]) == (4, spark.table("t_parts.counts").count())


def test_a_rename_reads_raw_counts_of_new_years_alone(spark, tmp_path, values, monkeypatch):
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    both, plans, written = raw_counts(spark, [2019, 2020]), {}, sinks.write_table

    def watched(df, path, *args, **options):
        plans[path] = df._jdf.queryExecution().executedPlan().toString()
        written(df, path, *args, **options)

    incremental.run(spark, raw_counts(spark, [2019]), areas(spark, "old"), step)
    monkeypatch.setattr(sinks, "write_table", watched)
    broken_off(monkeypatch, "impact_from", spark, both, areas(spark, "new"), step)
    assert "PartitionFilters: [isnotnull(load_year" in plans.pop(f"{step}/silver/counts")
    assert incremental.run(spark, both, areas(spark, "new"), step) == "LOADED"
    assert "PartitionFilters: [isnotnull(load_year" in plans[f"{step}/silver/counts"]
    incremental.run(spark, both, areas(spark, "new"), whole)
    assert gold_of(spark, step, values) == gold_of(spark, whole, values)


def test_only_a_run_that_replaced_single_years_leaves_silver_whole():
    assert not incremental._torn({})
    assert not incremental._torn({("counts", 2020): None, (incremental.SILVER_YEARS, None): None})
    assert incremental._torn({("counts", 2020): None})  # noted by a version that told nothing of silver
    assert incremental._torn({(incremental.SILVER_YEARS, None): None, (incremental.SILVER_WHOLE, None): None})
