"""Code lists, bands and the expressions that read them.

A NULL input takes the fallback label, as the source's rules have it; pass
``null_label`` to tell missing values apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Codes and the labels they stand for.
# --------------------------------------------------------------------------
SEVERITY = {1: "Fatal", 2: "Serious", 3: "Slight"}
LIGHT = {
    1: "Daylight",
    4: "Darkness - lights lit",
    5: "Darkness - lights unlit",
    6: "Darkness - no lighting",
    7: "Darkness - lighting unknown",
}
WEATHER = {
    1: "Fine no high winds",
    2: "Raining no high winds",
    3: "Snowing no high winds",
    4: "Fine + high winds",
    5: "Raining + high winds",
    6: "Snowing + high winds",
    7: "Fog or mist",
}
VEHICLE_TYPE = {
    1: "Pedal cycle",
    2: "Motorcycle 50cc and under",
    3: "Motorcycle 125cc and under",
    4: "Motorcycle over 125cc and up to 500cc",
    5: "Motorcycle over 500cc",
    8: "Taxi/Private hire car",
    9: "Car",
    10: "Minibus",
    11: "Bus or coach",
    19: "Goods vehicle",
    20: "Goods vehicle",
    21: "Goods vehicle",
    90: "Other vehicle",
}
CASUALTY_TYPE = {
    0: "Pedestrian",
    1: "Cyclist",
    2: "Motorcyclist",
    3: "Motorcyclist",
    4: "Motorcyclist",
    5: "Motorcyclist",
    8: "Car occupant",
    9: "Car occupant",
    11: "Bus/coach occupant",
    19: "Goods vehicle occupant",
    20: "Goods vehicle occupant",
    21: "Goods vehicle occupant",
    23: "Motorcyclist",
}
SEX = {1: "Male", 2: "Female"}
ROAD_CLASS = {
    "TA": "Motorway/Trunk A",
    "TM": "Motorway/Trunk A",
    "PA": "Principal A",
    "M": "Motorway",
}
ROAD_CATEGORY = {"Major": "A Road / Motorway", "Minor": "B Road / Minor"}
ENERGY = {
    "wind": "Renewable",
    "solar": "Renewable",
    "hydro": "Renewable",
    "nuclear": "Nuclear",
    "gas": "Fossil Fuel",
    "coal": "Fossil Fuel",
}
FUELS = ("biomass", "coal", "imports", "gas", "nuclear", "other", "hydro", "solar", "wind")
PERIOD_ORDER = {"morning_peak": 1, "evening_peak": 2, "inter_peak": 3, "evening": 4}

# Whole-number bands, both ends included.
DRIVER_AGES = [
    (17, 25, "17-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 55, "46-55"), (56, 65, "56-65"),
]
CASUALTY_AGES = [
    (0, 15, "0-15"), (16, 25, "16-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 55, "46-55"), (56, 65, "56-65"),
]
OLDEST_AGES = (65, "65+")
PERIOD_HOURS = [(7, 9), (10, 15), (16, 18), (19, 22)]
COUNT_PERIODS = ("morning_peak", "inter_peak", "evening_peak", "evening", "night")
COLLISION_PERIODS = ("Morning Rush", "Midday", "Evening Rush", "Evening", "Night")

# Label up to and including the bound, in rising order.
INTENSITY_CEILINGS = [(50, "Very Low"), (100, "Low"), (200, "Moderate"), (300, "High")]
RISK_CEILINGS = [(10, "Critical"), (50, "High"), (200, "Medium")]
SPEED_CEILINGS = [(30, "20-30 mph"), (50, "40-50 mph"), (60, "60 mph")]
EMISSION_CEILINGS = [(1.5, "Low Emission"), (2.5, "Medium Emission")]

# Label from the bound upwards, in falling order.
TIER_FLOORS = [(10, "Leading"), (5, "Progressing")]
CONGESTION_FLOORS = [(0.9, "Severely Congested"), (0.75, "Congested"), (0.5, "Moderate")]


def first_match(rules: Iterable[tuple[Column, object]], fallback: object) -> Column:
    """The label of the first rule that holds, else the fallback."""
    chosen = F.lit(fallback)
    for test, label in reversed(list(rules)):
        chosen = F.when(test, F.lit(label)).otherwise(chosen)
    return chosen


def _marked(c: Column, labelled: Column, null_label: str | None) -> Column:
    return labelled if null_label is None else F.when(c.isNull(), null_label).otherwise(labelled)


def decode(
    c: Column, codes: Mapping[object, object], fallback: object, null_label: str | None = None
) -> Column:
    """Look a code up; codes that share a label share one ``IN`` test."""
    members: dict[object, list[object]] = {}
    for code, label in codes.items():
        members.setdefault(label, []).append(code)
    rules = [(c.isin(*listed), label) for label, listed in members.items()]
    return _marked(c, first_match(rules, fallback), null_label)


def banded(
    c: Column, bands: Iterable[tuple[int, int]], names: Iterable[str], fallback: str,
    null_label: str | None = None,
) -> Column:
    rules = [(c.between(low, high), name) for (low, high), name in zip(bands, names)]
    return _marked(c, first_match(rules, fallback), null_label)


def up_to(
    c: Column, ceilings: Iterable[tuple[float, str]], fallback: str, null_label: str | None = None
) -> Column:
    return _marked(c, first_match([(c <= bound, name) for bound, name in ceilings], fallback), null_label)


def at_least(
    c: Column, floors: Iterable[tuple[float, str]], fallback: str, null_label: str | None = None
) -> Column:
    return _marked(c, first_match([(c >= bound, name) for bound, name in floors], fallback), null_label)


def _age_band(c: Column, bands: list[tuple[int, int, str]]) -> Column:
    rules = [(c.between(low, high), label) for low, high, label in bands]
    above, label = OLDEST_AGES
    return first_match([*rules, (c > above, label)], "Unknown")


def driver_age_band(c: Column) -> Column:
    """Drivers under 17 are Unknown."""
    return _age_band(c, DRIVER_AGES)


def casualty_age_band(c: Column) -> Column:
    return _age_band(c, CASUALTY_AGES)


def count_period(hour: Column, null_label: str | None = None) -> Column:
    return banded(hour, PERIOD_HOURS, COUNT_PERIODS, COUNT_PERIODS[-1], null_label)


def collision_period(hour: Column, null_label: str | None = None) -> Column:
    return banded(hour, PERIOD_HOURS, COLLISION_PERIODS, COLLISION_PERIODS[-1], null_label)


def severity(c: Column) -> Column:
    return decode(c, SEVERITY, "Unknown")


def light(c: Column) -> Column:
    return decode(c, LIGHT, "Unknown")


def weather(c: Column) -> Column:
    return decode(c, WEATHER, "Other/Unknown")


def vehicle_type(c: Column) -> Column:
    return decode(c, VEHICLE_TYPE, "Unknown")


def casualty_type(c: Column) -> Column:
    return decode(c, CASUALTY_TYPE, "Other")


def sex(c: Column) -> Column:
    return decode(c, SEX, "Unknown")


def is_urban(c: Column) -> Column:
    return F.coalesce(c == 1, F.lit(False))


def road_class(c: Column) -> Column:
    return decode(c, ROAD_CLASS, "Minor/B Road")


def road_category(c: Column) -> Column:
    return decode(c, ROAD_CATEGORY, "Unclassified")


def energy_category(fuel: Column) -> Column:
    return decode(fuel, ENERGY, "Other")


def intensity_category(c: Column, null_label: str | None = None) -> Column:
    return up_to(c, INTENSITY_CEILINGS, "Very High", null_label)


def risk_category(rank: Column) -> Column:
    return up_to(rank, RISK_CEILINGS, "Low")


def speed_band(c: Column, null_label: str | None = None) -> Column:
    return up_to(c, SPEED_CEILINGS, "70+ mph", null_label)


def emission_category(c: Column, null_label: str | None = None) -> Column:
    return up_to(c, EMISSION_CEILINGS, "High Emission", null_label)


def area_type(urban: Column) -> Column:
    return first_match([(urban, "Urban")], "Rural")


def sustainability_tier(index: Column, null_label: str | None = None) -> Column:
    return at_least(index, TIER_FLOORS, "Lagging", null_label)


def congestion_level(index: Column, null_label: str | None = None) -> Column:
    return at_least(index, CONGESTION_FLOORS, "Free Flow", null_label)


def period_sort_order(period: Column) -> Column:
    return decode(period, PERIOD_ORDER, 5)
