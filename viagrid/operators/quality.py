"""Data-quality expectations.

Every check returns rows ``rule, table_name, violations, total``. Row rules over
one table share a single pass, whatever their number. A test that is NULL counts
as no violation, so a range rule leaves missing values to the rule on NULLs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viagrid.functions import cleaning, labels, metrics

# Admissible members, and what a full table must cover.
SEVERITIES = ("Fatal", "Serious", "Slight")
SPEED_LIMITS = (20, 30, 40, 50, 60, 70)
REGION_NAMES = (
    "South West", "East Midlands", "Scotland", "Wales", "North West", "London",
    "East Of England", "Yorkshire And The Humber", "South East", "West Midlands", "North East",
)
ENERGY_REGION_IDS = tuple(range(1, 18))
EVENTS_PER_CYCLE = 180
PAGING_COLUMNS = ("current_page", "last_page", "total", "per_page")


def absent(name: str) -> Column:
    return F.col(name).isNull()


def out_of_area(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    return ~cleaning.within_area(latitude, longitude)


def out_of_range(name: str, low, high) -> Column:
    return ~F.col(name).between(low, high)


def negative(name: str) -> Column:
    return F.col(name) < 0


def below_sum(total: str, parts: Sequence[str]) -> Column:
    return F.col(total) < metrics.added(parts)


def blank(name: str) -> Column:
    return F.trim(name) == ""


def not_member(name: str, members: Sequence[object]) -> Column:
    return ~F.col(name).isin(*members)


def not_positive(name: str) -> Column:
    return F.col(name) <= 0


def in_future(name: str) -> Column:
    return F.col(name) > F.current_date()


def check_rows(df: DataFrame, table: str, violations: Mapping[str, Column]) -> DataFrame:
    """Count the rows that violate each rule, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *(F.count_if(test).alias(f"_{i}") for i, test in enumerate(violations.values())),
    )
    report = F.array(
        *(
            F.struct(F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations"))
            for i, rule in enumerate(violations)
        )
    )
    return counted.select("_total", F.explode(report).alias("_r")).select(
        F.col("_r.rule").alias("rule"),
        F.lit(table).alias("table_name"),
        F.col("_r.violations").alias("violations"),
        F.col("_total").alias("total"),
    )


def null_counts(df: DataFrame, table: str, columns: Iterable[str] | None = None) -> DataFrame:
    """NULLs per column, of all columns unless some are named."""
    names = list(columns) if columns is not None else df.columns
    return check_rows(df, table, {f"null:{name}": absent(name) for name in names})


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, out of all keys."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return check_rows(groups, table, {f"unique:{','.join(keys)}": F.col("_n") > 1})


def check_coverage(observed: DataFrame, table: str, key: str, expected: Sequence[object]) -> DataFrame:
    """Expected members that the data lacks, out of all expected."""
    wanted = F.array(*(F.lit(member) for member in expected))
    present = observed.agg(
        F.collect_set(F.when(F.col(key).isin(*expected), F.col(key))).alias("_present")
    )
    return present.select(
        F.lit(f"coverage:{key}").alias("rule"),
        F.lit(table).alias("table_name"),
        F.size(F.array_except(wanted, "_present")).cast("bigint").alias("violations"),
        F.lit(len(expected)).cast("bigint").alias("total"),
    )


def missing_members(observed: DataFrame, key: str, expected: Sequence[object]) -> DataFrame:
    """The expected members themselves that the data lacks."""
    wanted = F.array(*(F.lit(member) for member in expected))
    present = observed.agg(
        F.collect_set(F.when(F.col(key).isin(*expected), F.col(key))).alias("_present")
    )
    return present.select(F.explode(F.array_except(wanted, "_present")).alias(key))


def check_columns(
    df: DataFrame, table: str, required: Sequence[str] = (), forbidden: Sequence[str] = ()
) -> DataFrame:
    """Columns that must or must not be there; ``total`` is the row count."""
    lacking = [name for name in required if name not in df.columns]
    unwanted = [name for name in forbidden if name in df.columns]
    rules = {}
    if required:
        rules[f"required:{','.join(required)}"] = len(lacking)
    if forbidden:
        rules[f"forbidden:{','.join(forbidden)}"] = len(unwanted)
    counted = df.agg(F.count(F.lit(1)).alias("total"))
    report = F.array(
        *(
            F.struct(F.lit(rule).alias("rule"), F.lit(n).cast("bigint").alias("violations"))
            for rule, n in rules.items()
        )
    )
    return counted.select("total", F.explode(report).alias("_r")).select(
        "_r.rule", F.lit(table).alias("table_name"), "_r.violations", "total"
    )


def check_shares(mix: DataFrame, table: str, by: Sequence[str], share: str) -> DataFrame:
    """Groups whose percentages do not add up to 99..101."""
    sums = mix.groupBy(*by).agg(metrics.exact_sum(F.col(share), 6).alias("_sum"))
    return check_rows(sums, table, {f"sums_to_100:{share}": out_of_range("_sum", 99, 101)})


def check_cycle_size(events: DataFrame, table: str, cycle: str, expected: int = EVENTS_PER_CYCLE) -> DataFrame:
    """Polling cycles that hold another number of events than expected."""
    sizes = events.groupBy(cycle).agg(F.count(F.lit(1)).alias("_n"))
    return check_rows(sizes, table, {f"events_per_cycle:{expected}": F.col("_n") != expected})


def check_event_fields(events: DataFrame, table: str) -> DataFrame:
    """Fields each kind of event must carry, and the ranges of its numbers."""
    kind = F.col("event_type")
    intensity = ("forecast", "intensity_index")
    needs = {
        "national_intensity": (*intensity, "actual"),
        "generation_mix": ("fuel_type", "fuel_percentage"),
        "regional_intensity": (*intensity, "region_id", "region_name"),
        "regional_generation": ("region_id", "region_name", "fuel_type", "fuel_percentage"),
    }
    rules = {
        f"fields:{name}": (kind == name) & ~cleaning.all_present(*fields)
        for name, fields in needs.items()
    }
    rules["percentage_0_100"] = out_of_range("fuel_percentage", 0, 100)
    rules["region_id_from_1"] = F.col("region_id") < 1
    return check_rows(events, table, rules)



def rules_of(table: str, columns: Sequence[str], first_year: int = 2000, last_year: int | None = None) -> dict[str, Column]:
    """The row rules of a table, those whose columns are there.

    ``last_year`` None takes the running year.
    """
    last = F.year(F.current_date()) if last_year is None else F.lit(last_year)
    area = {
        "latitude,longitude": {
            "null:latitude": absent("latitude"), "null:longitude": absent("longitude"), "inside_area": out_of_area(),
        }
    }
    volumes = ("cars_and_taxis", "all_hgvs", "pedal_cycles")
    counts = {
        "count_point_id": {"null:count_point_id": absent("count_point_id")},
        **area,
        "year": {"year_range": (F.col("year") < first_year) | (F.col("year") > last)},
        **{name: {f"not_negative:{name}": negative(name)} for name in (*volumes, "total_vehicles")},
        ",".join(("total_vehicles", *volumes)): {"total_covers_parts": below_sum("total_vehicles", volumes)},
        "region_name": {"not_blank:region_name": blank("region_name")},
    }
    collisions = {
        "collision_id": {"null:collision_id": absent("collision_id")},
        **area,
        "severity_label": {"member:severity_label": not_member("severity_label", SEVERITIES)},
        "speed_limit": {"member:speed_limit": not_member("speed_limit", SPEED_LIMITS)},
        "number_of_casualties": {"positive:number_of_casualties": not_positive("number_of_casualties")},
        "collision_date": {"no_future:collision_date": in_future("collision_date")},
    }
    events = {
        "fuel_type": {"member:fuel_type": not_member("fuel_type", labels.FUELS)},
        "fuel_percentage": {"percentage_0_100": out_of_range("fuel_percentage", 0, 100)},
        "region_id": {"region_id_from_1": F.col("region_id") < 1},
    }
    points = {
        "count_point_id": {"null:count_point_id": absent("count_point_id")}, **area,
        "road_name": {"not_blank:road_name": blank("road_name")},
    }
    areas = {"id": {"null:id": absent("id")}, "name": {"null:name": absent("name"), "not_blank:name": blank("name")}}
    vehicles = {
        "collision_id": {"null:collision_id": absent("collision_id")},
        "vehicle_reference": {"null:vehicle_reference": absent("vehicle_reference")},
    }
    casualties = {
        "collision_id": {"null:collision_id": absent("collision_id")},
        "casualty_reference": {"null:casualty_reference": absent("casualty_reference")},
        "casualty_severity_label": {"member:casualty_severity_label": not_member("casualty_severity_label", SEVERITIES)},
    }
    emissions = {"co2_per_vehicle_kg": {"co2_1_5": out_of_range("co2_per_vehicle_kg", 1, 5)}}
    known = {
        "counts": counts, "collisions": collisions, "events": events, "fact_co2_emissions": emissions, "count_points": points,
        "regions": areas, "local_authorities": areas, "vehicles": vehicles, "casualties": casualties,
    }[table]
    return {rule: test for needs, rules in known.items() if set(needs.split(",")) <= set(columns) for rule, test in rules.items()}


# Keys that are unique in a table, those whose columns are there.
UNIQUE_KEYS = {
    "counts": ("count_point_id", "year", "count_date", "hour", "direction_of_travel"),
    "collisions": ("collision_id",),
    "count_points": ("count_point_id",),
    "regions": ("id",),
    "local_authorities": ("id",),
    "vehicles": ("collision_id", "vehicle_reference"),
    "casualties": ("collision_id", "casualty_reference"),
}


def suite(df: DataFrame, table: str, first_year: int = 2000, last_year: int | None = None) -> DataFrame:
    """Every rule of a table as one report: the row rules in one pass, then its unique key and event fields."""
    report = check_rows(df, table, rules_of(table, df.columns, first_year, last_year))
    keys = UNIQUE_KEYS.get(table, ())
    if keys and set(keys) <= set(df.columns):
        report = report.unionByName(check_unique(df, table, keys))
    if table == "events":
        report = report.unionByName(check_event_fields(df, table).filter(F.col("rule").startswith("fields:")))
    return report


class RuleViolated(Exception):
    """A table breaks rules that a run insists on."""


def gate(report: DataFrame, tolerated: Sequence[str] = ()) -> None:
    """Stop unless every rule of the report, but for those tolerated, holds."""
    broken = report.filter((F.col("violations") > 0) & ~F.col("rule").isin(*tolerated, "")).collect()
    if broken:
        raise RuleViolated("; ".join(f"{r.table_name} {r.rule}: {r.violations} of {r.total}" for r in broken))
