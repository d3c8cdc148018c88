"""Event envelopes: from polled snapshots, from a broker, and parsed to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viagrid import schemas
from viagrid.functions.cleaning import moment

ENVELOPE = ("raw_json", "partition_id", "enqueued_time", "sequence_number")

# Payload field -> column of the parsed table.
PARSED_NAMES = {
    "event_type": "event_type",
    "timestamp": "data_timestamp",
    "from": "period_from",
    "to": "period_to",
    "forecast": "forecast",
    "actual": "actual",
    "index": "intensity_index",
    "fuel": "fuel_type",
    "percentage": "fuel_percentage",
    "region_id": "region_id",
    "region_name": "region_name",
    "dno_region": "dno_region",
}
EVENT_FIELDS = tuple(PARSED_NAMES)
NUMBERS = {"forecast": "double", "actual": "double", "percentage": "double", "region_id": "int"}


def _event(kind: str, **fields: Column) -> Column:
    """One event with every payload field, those not given NULL."""
    given = {"event_type": F.lit(kind), **{name.rstrip("_"): c for name, c in fields.items()}}
    return F.struct(
        *(
            given.get(name, F.lit(None)).cast(NUMBERS.get(name, "string")).alias(name)
            for name in EVENT_FIELDS
        )
    )


def flatten_snapshots(snapshots: DataFrame) -> DataFrame:
    """Events of polled snapshots (``schemas.SNAPSHOT``), one row per event.

    Each snapshot's four kinds of event are put in one array and exploded, so
    the snapshots are read once. Regional mix events have no period.
    """
    at = F.col("polled_at")
    national, mix, regional = F.col("national"), F.col("generation"), F.col("regional")

    def in_region(region: Column) -> Column:
        intensity = _event(
            "regional_intensity", timestamp=at, from_=regional["from"], to=regional["to"],
            region_id=region["regionid"], region_name=region["shortname"],
            dno_region=region["dnoregion"], forecast=region["intensity"]["forecast"],
            index=region["intensity"]["index"],
        )
        shares = F.transform(
            region["generationmix"],
            lambda fuel: _event(
                "regional_generation", timestamp=at, region_id=region["regionid"],
                region_name=region["shortname"], fuel=fuel["fuel"], percentage=fuel["perc"],
            ),
        )
        return F.concat(F.array(intensity), F.coalesce(shares, F.array()))

    one_national = _event(
        "national_intensity", timestamp=at, from_=national["from"], to=national["to"],
        forecast=national["intensity"]["forecast"], actual=national["intensity"]["actual"],
        index=national["intensity"]["index"],
    )
    fuels = F.transform(
        mix["generationmix"],
        lambda fuel: _event(
            "generation_mix", timestamp=at, from_=mix["from"], to=mix["to"],
            fuel=fuel["fuel"], percentage=fuel["perc"],
        ),
    )
    regions = F.flatten(F.transform(regional["regions"], in_region))
    events = F.concat(
        F.when(national.isNotNull(), F.array(one_national)).otherwise(F.array()),
        F.coalesce(fuels, F.array()),
        F.coalesce(regions, F.array()),
    )
    return snapshots.select(F.inline(events))


def to_json_text(events: DataFrame) -> DataFrame:
    """Events as JSON text, fields without a value left out."""
    return events.select(F.to_json(F.struct(*EVENT_FIELDS)).alias("raw_json"))


def from_kafka(records: DataFrame) -> DataFrame:
    """Envelope columns of Kafka records, batch or streaming."""
    return records.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("partition").cast("string").alias("partition_id"),
        F.col("timestamp").cast("string").alias("enqueued_time"),
        F.col("offset").alias("sequence_number"),
    )


def parsed(envelopes: DataFrame) -> DataFrame:
    """Flat, typed events; text that does not parse gives NULL fields."""
    body = F.from_json("raw_json", schemas.EVENT_PAYLOAD).alias("body")
    read = envelopes.select(moment(F.col("enqueued_time")).alias("event_time"), body)
    fields = [F.col("body")[field].alias(name) for field, name in PARSED_NAMES.items()]
    return read.select("event_time", *fields).withColumn(
        "data_timestamp", moment(F.col("data_timestamp"))
    )
