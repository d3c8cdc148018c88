import json

import pytest
from pyspark.sql import functions as F

from viagrid.sources import sinks
from viagrid.sources.batches import BatchTable
from viagrid.streaming import carbon, jobs, payload

FUELS = {"gas": 22.1, "wind": 22.7, "solar": 23.4, "nuclear": 14.7, "imports": 11.1, "biomass": 6.0,
         "hydro": 0.5, "coal": 0.0, "other": 0.0}


def snapshot(at):
    mix = [{"fuel": fuel, "perc": share} for fuel, share in FUELS.items()]
    period = {"from": f"{at[:13]}:00Z", "to": f"{at[:13]}:30Z"}
    regions = [
        {"regionid": i, "shortname": f"R{i}", "dnoregion": f"D{i}", "intensity": {"forecast": float(i), "index": "low"},
         "generationmix": mix} for i in range(1, 18)]
    return {"polled_at": at, "national": {**period, "intensity": {"forecast": 142.0, "actual": 160.0, "index": "moderate"}},
            "generation": {**period, "generationmix": mix}, "regional": {**period, "regions": regions}}


@pytest.fixture(scope="module")
def polled(spark, tmp_path_factory):
    """Envelopes of two polls; all events of a poll arrive together."""
    from viagrid import schemas

    folder = tmp_path_factory.mktemp("polls")
    for n, at in enumerate(("2026-06-25T16:00:00", "2026-06-25T17:00:00")):
        (folder / f"{n}.json").write_text(json.dumps(snapshot(at)))
    polls = spark.read.schema(schemas.SNAPSHOT).json(str(folder))
    events = payload.flatten_snapshots(polls)
    return payload.to_json_text(events).select(
        "raw_json", F.lit("0").alias("partition_id"),
        F.get_json_object("raw_json", "$.timestamp").alias("enqueued_time"),
        F.monotonically_increasing_id().alias("sequence_number"))


def test_a_poll_holds_180_events(polled):
    kinds = payload.parsed(polled).groupBy("data_timestamp", "event_type").count().collect()
    sizes = {kind: n for _, kind, n in kinds}
    assert sizes == {"national_intensity": 1, "generation_mix": 9, "regional_intensity": 17, "regional_generation": 153}
    assert len(kinds) == 8


def test_parsing_tolerates_what_is_no_json(spark):
    rows = [('{"event_type":"generation_mix","fuel":"wind","percentage":27.3}', "2026-06-25 16:00:00"), ('{"oops', None)]
    found = payload.parsed(spark.createDataFrame(rows, "raw_json string, enqueued_time string")).collect()
    assert (found[0].event_type, found[0].fuel_type, found[0].fuel_percentage, found[0].forecast) == (
        "generation_mix", "wind", 27.3, None)
    assert found[1].event_type is None and found[1].event_time is None


def test_empty_snapshot_parts_give_no_events(spark):
    from viagrid import schemas

    empty = spark.createDataFrame([("t", None, None, None)], schemas.SNAPSHOT)
    assert payload.flatten_snapshots(empty).count() == 0


def test_gold_tables_of_the_latest_poll(polled):
    events = carbon.latest_cycle(payload.parsed(polled))
    national = carbon.national_intensity(events).collect()
    assert [(r.forecast_vs_actual, r.intensity_category) for r in national] == [(18.0, "Moderate")]
    summary = {r.energy_category: r.total_percentage for r in carbon.renewable_summary(events).collect()}
    assert summary["Renewable"] == 46.6 and sum(summary.values()) == pytest.approx(100.5)
    assert carbon.regional_intensity(events).count() == 17
    regional = carbon.regional_generation(events)
    assert regional.count() == 153 and regional.filter("period_from is not null").count() == 0


def test_repeats_inflate_only_the_faithful_sum(polled):
    events = carbon.latest_cycle(payload.parsed(polled.unionByName(polled)))
    clean = carbon.renewable_summary(events).filter("energy_category = 'Nuclear'").first()
    raw = carbon.renewable_summary(events, count_repeats=True).filter("energy_category = 'Nuclear'").first()
    assert (clean.total_percentage, raw.total_percentage) == (14.7, 29.4)


def test_ingestion_takes_each_event_once_across_runs(spark, polled, tmp_path):
    log, bronze, progress = (str(tmp_path / n) for n in ("log", "bronze", "progress"))
    first = polled.filter("enqueued_time like '%T16%'")
    sinks.append_rows(first, log)
    for _ in range(2):
        jobs.ingest(jobs.folder_log(spark, log), bronze, progress)
    assert spark.read.parquet(bronze).count() == 180
    sinks.append_rows(polled.filter("enqueued_time like '%T17%'"), log)
    jobs.ingest(jobs.folder_log(spark, log), bronze, progress)
    assert spark.read.parquet(bronze).count() == 360


def test_stream_drops_events_sent_again(spark, polled, tmp_path):
    log = str(tmp_path / "log")
    sinks.append_rows(polled, log)
    sinks.append_rows(polled, log)
    assert jobs.without_repeats(spark.read.parquet(log), None).count() == 360
    stream = jobs.without_repeats(jobs.folder_log(spark, log), None)
    jobs.ingest(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 360


def test_streamed_tables_equal_batch_tables(spark, polled, tmp_path, values):
    log, silver, gold = (str(tmp_path / n) for n in ("log", "silver", "gold"))
    sinks.append_rows(polled, log)
    jobs.refresh_tables(jobs.folder_log(spark, log), silver, gold, str(tmp_path / "progress"))
    events = carbon.latest_cycle(payload.parsed(polled))
    assert spark.read.parquet(silver).count() == 360
    for name, build in carbon.GOLD.items():
        batch = build(events)
        assert values(spark.read.parquet(f"{gold}/{name}"), *batch.columns) == values(batch), name


def test_streamed_timeline_equals_batch_over_two_runs(spark, polled, tmp_path, values):
    log, table, progress = (str(tmp_path / n) for n in ("log", "table", "progress"))
    sinks.append_rows(polled.filter("enqueued_time like '%T16%'"), log)
    jobs.keep_timeline(jobs.folder_log(spark, log), table, progress)
    sinks.append_rows(polled.filter("enqueued_time like '%T17%'"), log)
    jobs.keep_timeline(jobs.folder_log(spark, log), table, progress)
    batch = carbon.timeline(payload.parsed(polled))
    assert values(spark.read.parquet(table), *batch.columns) == values(batch) and batch.count() == 2


def batches(spark, folder, *parts):
    import time

    for number, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{folder}/{number}")
        time.sleep(1.1)
    return jobs.folder_log(spark, f"{folder}/*", files_per_batch=1)


def test_a_late_batch_changes_history_but_not_the_newest_cycle(spark, polled, tmp_path, values):
    early, late = polled.filter("enqueued_time like '%T16%'"), polled.filter("enqueued_time like '%T17%'")
    odd = late.filter("sequence_number % 2 = 1")
    log = batches(spark, str(tmp_path / "log"), odd, late.filter("sequence_number % 2 = 0"), early)
    for latest, events in ((True, carbon.latest_cycle(payload.parsed(polled))), (False, payload.parsed(polled))):
        silver, gold = str(tmp_path / f"silver{latest}"), str(tmp_path / f"gold{latest}")
        jobs.refresh_tables(log, silver, gold, str(tmp_path / f"progress{latest}"), latest)
        assert spark.read.parquet(silver).count() == 360
        for name, build in carbon.GOLD.items():
            batch = build(events)
            assert values(spark.read.parquet(f"{gold}/{name}"), *batch.columns) == values(batch), name


def test_late_and_repeated_events_are_kept_once(spark, polled, tmp_path):
    early = polled.filter("enqueued_time like '%T16%'")
    log = batches(spark, str(tmp_path / "log"), polled.filter("enqueued_time like '%T17%'"), polled, early)
    bronze = str(tmp_path / "bronze")
    jobs.ingest_once(log, bronze, str(tmp_path / "progress"))
    stored = spark.read.parquet(bronze)
    assert stored.count() == 360 and stored.select("partition_id", "sequence_number").distinct().count() == 360


def test_a_new_checkpoint_leaves_what_is_stored(spark, polled, tmp_path, values):
    early, late = (polled.filter(f"enqueued_time like '%T{hour}%'") for hour in (16, 17))
    bronze, silver, gold, table = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "timeline"))
    for name, part in (("a", early), ("b", late), ("c", early)):  # the third is the first log again, its checkpoint lost
        sinks.append_rows(part, str(tmp_path / f"log-{name}"))
        log = jobs.folder_log(spark, str(tmp_path / f"log-{name}"))
        jobs.ingest_once(log, bronze, str(tmp_path / f"bronze-{name}"))
        if name != "c":
            jobs.refresh_tables(log, silver, gold, str(tmp_path / f"silver-{name}"), latest_only=False)
            jobs.keep_timeline(log, table, str(tmp_path / f"timeline-{name}"))
    keys = list(jobs.EVENT_KEYS)
    assert values(jobs.raw_table(spark, bronze).read(), *keys) == values(polled, *keys)
    assert jobs.silver_table(spark, silver).read().count() == 360
    batch = carbon.timeline(payload.parsed(polled))
    assert values(spark.read.parquet(table), *batch.columns) == values(batch) and batch.count() == 2
    for name, build in carbon.GOLD.items():
        whole = build(payload.parsed(polled))
        assert values(spark.read.parquet(f"{gold}/{name}"), *whole.columns) == values(whole), name


def test_a_batch_that_broke_off_counts_once(spark, polled, tmp_path, monkeypatch):
    log, bronze = str(tmp_path / "log"), str(tmp_path / "bronze")
    sinks.append_rows(polled, log)
    publish = BatchTable._publish

    def broken(table, listing):
        raise RuntimeError("lost")

    for broken_publish in (broken, lambda table, listing: publish(table, listing) and broken(table, listing)):
        monkeypatch.setattr(BatchTable, "_publish", broken_publish)
        with pytest.raises(Exception, match="lost"):
            jobs.ingest_once(jobs.folder_log(spark, log), bronze, str(tmp_path / "progress"))
    monkeypatch.setattr(BatchTable, "_publish", publish)
    jobs.ingest_once(jobs.folder_log(spark, log), bronze, str(tmp_path / "progress"))
    assert jobs.raw_table(spark, bronze).read().count() == 360
    assert jobs.raw_log(spark, bronze).isStreaming


def test_writers_at_once_keep_each_event_once(spark, polled, tmp_path, monkeypatch):
    log, bronze = str(tmp_path / "log"), str(tmp_path / "bronze")
    sinks.append_rows(polled, log)
    write, done = BatchTable.write, []

    def overtaken(table, df, owner, number):
        entry = write(table, df, owner, number)
        if not done:
            done.append(1)
            jobs.ingest_once(jobs.folder_log(spark, log), bronze, str(tmp_path / "other"))
        return entry

    monkeypatch.setattr(BatchTable, "write", overtaken)
    jobs.ingest_once(jobs.folder_log(spark, log), bronze, str(tmp_path / "progress"))
    assert jobs.raw_table(spark, bronze).read().count() == 360


def test_the_last_arrival_reads_one_day(spark, polled, tmp_path):
    bronze = str(tmp_path / "bronze")
    sinks.append_rows(polled, str(tmp_path / "log"))
    jobs.ingest(jobs.folder_log(spark, str(tmp_path / "log")), bronze, str(tmp_path / "progress"))
    plan = carbon.latest_arrival(spark.read.parquet(bronze))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert any("arrival_date" in line and "ubquery" in line for line in plan.splitlines() if "PartitionFilters" in line)
    assert carbon.latest_arrival(spark.read.parquet(bronze)).count() == 180


def test_a_revision_replaces_what_it_revises(spark):
    kind = "event_type string, data_timestamp timestamp_ntz, period_from string, period_to string, forecast double, actual double, intensity_index string"
    import datetime as dt

    rows = [("national_intensity", dt.datetime(2026, 1, 1, h), "p", "q", float(h), None if h == 3 else 1.0, "low") for h in (1, 3, 2)]
    assert [r.forecast for r in carbon.national_intensity(spark.createDataFrame(rows, kind)).collect()] == [3.0]


def test_no_reading_stops_the_timeline(spark):
    rows = [("national_intensity", "2026-01-01 00:00:00", 1e300, 5.0), ("national_intensity", "2026-01-01 00:10:00", 2.0, float("inf"))]
    events = spark.createDataFrame(rows, "event_type string, data_timestamp string, forecast double, actual double")
    found = carbon.timeline(events.withColumn("data_timestamp", F.col("data_timestamp").cast("timestamp"))).collect()
    assert [(r.readings, r.avg_forecast, r.avg_actual) for r in found] == [(2, 2.0, 5.0)]


def test_kafka_records_become_envelopes(spark):
    records = spark.createDataFrame(
        [(bytearray(b'{"a":1}'), 3, 42)], "value binary, partition int, offset long").withColumn(
        "timestamp", F.lit("2026-06-25 16:00:00").cast("timestamp"))
    assert tuple(payload.from_kafka(records).first()) == ('{"a":1}', "3", "2026-06-25 16:00:00", 42)
