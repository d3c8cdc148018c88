"""Which tables there are, by layer, and where they are registered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viagrid.plans import incremental
from viagrid.sources import catalog
from viagrid.streaming import carbon

# The tables of each layer on annual flows, and those on events.
LAYERS = {
    "bronze": ("counts", "regions", "local_authorities", "count_points"),
    "silver": ("counts", "regions", "local_authorities", "count_points"),
    "gold": (
        "fact_traffic_summary", "fact_co2_emissions", "fact_vehicle_mix", "fact_road_analysis",
        "fact_covid_impact", "fact_busiest_roads", "dim_location", "dim_date",
    ),
    "events": tuple(carbon.GOLD),
}


def table_paths(spark: SparkSession, base: str, events_base: str) -> dict[str, dict[str, str]]:
    """Path of every table by layer, below the base of the incremental runs and that of the event tables."""
    paths = {layer: {name: f"{base}/{layer}/{name}" for name in LAYERS[layer]} for layer in ("bronze", "silver")}
    paths["gold"] = {name: incremental.gold_path(spark, base, name) for name in LAYERS["gold"]}
    paths["events"] = {name: f"{events_base}/{name}" for name in LAYERS["events"]}
    return paths


def register_all(spark: SparkSession, paths: dict[str, dict[str, str]], prefix: str = "", location: str | None = None) -> list[str]:
    """Register each layer's tables in a schema of its own; returns the schemas."""
    schemas = []
    for layer, tables in paths.items():
        schema = f"{prefix}{layer}"
        catalog.create_schema(spark, schema, f"{location}/{schema}" if location else None)
        catalog.register(spark, schema, tables)
        schemas.append(schema)
    return schemas


def audit_all(spark: SparkSession, schemas: list[str]) -> DataFrame:
    """Tables of all layers with their row counts and kinds."""
    reports = [catalog.audit(spark, schema) for schema in schemas]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out
