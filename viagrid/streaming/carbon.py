"""Gold tables on carbon-intensity events.

Plain DataFrame functions, used alike on stored events and inside a stream's
batches. ``latest_by`` restricts a table to the last polling cycle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viagrid.functions import labels, metrics
from viagrid.operators.keyed import one_per_key

KINDS = ("national_intensity", "generation_mix", "regional_intensity", "regional_generation")

# Of several events of a key the one polled last counts, so a revision replaces what it revises.
LATEST = ("data_timestamp",)


def latest_by(df: DataFrame, moment: Column) -> DataFrame:
    """Rows of the last moment, found by a scalar subquery."""
    return df.filter(moment == df.agg(F.max(moment)).scalar())


def latest_arrival(envelopes: DataFrame) -> DataFrame:
    """The cycle that arrived last; of a raw table only its last arrival date is read."""
    if "arrival_date" not in envelopes.columns:
        return latest_by(envelopes, F.col("enqueued_time").try_cast("timestamp"))
    return latest_by(latest_by(envelopes, F.col("arrival_date")), F.col("arrived_at"))


def latest_cycle(events: DataFrame) -> DataFrame:
    """The cycle that was polled last."""
    return latest_by(events, F.col("data_timestamp"))


def of_kind(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("event_type") == kind)


def national_intensity(events: DataFrame) -> DataFrame:
    chosen = of_kind(events, "national_intensity").select(
        "data_timestamp", "period_from", "period_to", "forecast", "actual", "intensity_index"
    )
    return one_per_key(chosen, ["period_from"], LATEST).withColumns(
        {
            "forecast_vs_actual": metrics.change(F.col("actual"), F.col("forecast")),
            "intensity_category": labels.intensity_category(F.col("actual")),
        }
    )


def generation_mix(events: DataFrame) -> DataFrame:
    chosen = of_kind(events, "generation_mix").select(
        "data_timestamp", "period_from", "period_to", "fuel_type", "fuel_percentage"
    )
    return one_per_key(chosen, ["period_from", "fuel_type"], LATEST).withColumn(
        "energy_category", labels.energy_category(F.col("fuel_type"))
    )


def regional_intensity(events: DataFrame) -> DataFrame:
    chosen = of_kind(events, "regional_intensity").select(
        "data_timestamp", "period_from", "period_to", "region_id", "region_name",
        "dno_region", "forecast", "intensity_index",
    )
    return one_per_key(chosen, ["period_from", "region_id"], LATEST).withColumn(
        "intensity_category", labels.intensity_category(F.col("forecast"))
    )


def regional_generation(events: DataFrame) -> DataFrame:
    """Regional shares. These events carry no period; the cycle that polled them stands for it."""
    chosen = of_kind(events, "regional_generation").select(
        "data_timestamp", "period_from", "region_id", "region_name", "fuel_type", "fuel_percentage"
    )
    cycle = F.coalesce("period_from", F.col("data_timestamp").cast("string"))
    kept = one_per_key(chosen.withColumn("_cycle", cycle), ["_cycle", "region_id", "fuel_type"], LATEST)
    return kept.drop("_cycle").withColumn(
        "energy_category", labels.energy_category(F.col("fuel_type"))
    )


def renewable_summary(events: DataFrame, count_repeats: bool = False) -> DataFrame:
    """Share per period and energy category.

    Repeated events are dropped before the sum; ``count_repeats`` adds them all,
    as the feed's own consumers do.
    """
    mix = of_kind(events, "generation_mix")
    mix = (
        mix.withColumn("energy_category", labels.energy_category(F.col("fuel_type")))
        if count_repeats
        else generation_mix(events)
    )
    return mix.groupBy("period_from", "energy_category").agg(
        metrics.exact_sum(F.col("fuel_percentage"), 6).alias("total_percentage")
    )


GOLD = {
    "gold_national_intensity": national_intensity,
    "gold_generation_mix": generation_mix,
    "gold_regional_intensity": regional_intensity,
    "gold_regional_generation": regional_generation,
    "gold_renewable_summary": renewable_summary,
}


# Value columns of the timeline, each with its decimals.
READINGS = {"forecast": 2, "actual": 2}


def timeline_sums(events: DataFrame, at: str = "data_timestamp", width: str = "30 minutes") -> DataFrame:
    """Readings, and sums and counts of forecast and actual, per time window; they can be added up."""
    units = {name: metrics.as_units(F.col(name), digits) for name, digits in READINGS.items()}
    return (
        of_kind(events, "national_intensity")
        .groupBy(F.window(at, width))
        .agg(
            F.count(F.lit(1)).alias("readings"),
            *(F.sum(c).alias(f"{name}_units") for name, c in units.items()),
            *(F.count(c).alias(f"{name}_count") for name, c in units.items()),
        )
        .select(
            F.col("window.start").alias("window_start"), "readings",
            *(f"{name}_{part}" for name in READINGS for part in ("units", "count")),
        )
    )


def timeline_of(sums: DataFrame) -> DataFrame:
    """The timeline from sums of one or more parts of the events."""
    return sums.groupBy("window_start").agg(
        F.sum("readings").alias("readings"),
        *(
            metrics.mean_of_units(F.sum(f"{name}_units"), F.sum(f"{name}_count"), digits).alias(f"avg_{name}")
            for name, digits in READINGS.items()
        ),
    )


def timeline(events: DataFrame, at: str = "data_timestamp", width: str = "30 minutes") -> DataFrame:
    """Mean forecast and actual intensity, and their number, per time window."""
    return timeline_of(timeline_sums(events, at, width))


def category_trend(events: DataFrame, at: str = "data_timestamp", width: str = "30 minutes") -> DataFrame:
    """Mean fuel share per energy category and time window."""
    return (
        of_kind(events, "generation_mix")
        .withColumn("energy_category", labels.energy_category(F.col("fuel_type")))
        .groupBy(F.window(at, width), "energy_category")
        .agg(metrics.exact_mean(F.col("fuel_percentage"), 6).alias("avg_percentage"))
        .select(F.col("window.start").alias("window_start"), "energy_category", "avg_percentage")
    )
