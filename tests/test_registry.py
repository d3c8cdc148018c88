"""The registered queries: complete, and equal to their SQL on the smallest data."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import TABLES, difference, ordered

FOLDER = "/root/testdata/sf0.001"
IDS = (
    [f"S{i}" for i in range(1, 13)] + [f"K{i}" for i in range(1, 16)] + [f"P{i}" for i in range(1, 13)]
    + [f"SV{i}" for i in range(1, 11)] + [f"C{i}" for i in range(1, 20)] + [f"L{i}" for i in range(1, 22)] + ["L1b"]
    + [f"J{i}" for i in range(1, 12)] + [f"A{i}" for i in range(1, 22)] + [f"D{i}" for i in range(1, 5)]
    + [f"W{i}" for i in range(1, 7)] + [f"O{i}" for i in range(1, 7)] + [f"U{i}" for i in range(1, 5)]
    + [f"E{i}" for i in range(1, 13)] + [f"I{i}" for i in range(1, 6)] + [f"V{i}" for i in range(1, 10)]
    + [f"M{i}" for i in range(1, 15)] + [f"Q{i}" for i in range(1, 20)]
)
SAMPLE = (
    "SV2_counts_hourly", "SV4_collisions", "SV7_counts_annual", "SV10_events", "A3_fact_yoy_regional",
    "A4_fact_co2_emissions_hourly", "A8_fact_accident_hotspots", "A10_fact_vehicle_analysis", "A12_fact_traffic_summary",
    "A13_fact_co2_emissions_annual", "A16_fact_covid_impact", "A17_fact_busiest_roads_latest", "D3_dim_location",
    "E4_stream_three_batches_history_gold_regional_generation", "E4_stream_late_batch_latest_gold_national_intensity",
    "E10_stream_late_event_kept", "E12_stream_timeline_in_batches", "I2_resumed_after_failure", "P2_typed_casts",
    "S3_json_plain_list_whole_files", "B_run_raw_layer", "B_run_refuses_missing_pages", "V8_batch_folder_views",
    "Q_suite_counts", "V1_traffic_summary_view", "E9_gold_renewable_summary", "E11_flatten_snapshots", "U2_one_per_key",
)


def test_every_operator_has_a_query_and_sql():
    covered = {part for key in contract.QUERIES for part in re.findall(r"(?:^|_)([A-Z]{1,2}\d+b?)(?=_)", key)}
    assert not [i for i in IDS if i not in covered]
    assert set(contract.QUERIES) == set(contract.ORACLES)


needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@needs_data
def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("key", sorted(contract.QUERIES) if os.environ.get("CHECK_ALL") else SAMPLE)
def test_query_equals_its_sql(spark, key):
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    frame = contract.queries()[key](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
    found = duck.execute(contract.oracle_sql()[key])
    names = [column[0] for column in found.description]
    assert sorted(names) == sorted(frame.columns)
    assert difference(ordered(frame.columns, frame.collect()), ordered(names, found.fetchall())) == ""
