"""Ratios, shares, emission estimates, and sums that do not depend on task order.

Adding doubles in another order can change the last digits, so a retried task or
another partition number could change a result. Values with a known number of
decimals are therefore summed as whole units (``exact_sum``, ``exact_mean``).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grams of CO2 per km by kind of vehicle, and the average trip in km.
GRAMS_PER_KM = {
    "pedal_cycles": 0,
    "two_wheeled_motor_vehicles": 83,
    "cars_and_taxis": 164,
    "buses_and_coaches": 822,
    "lgvs": 209,
    "all_hgvs": 586,
}
TRIP_KM = 12.8

VEHICLE_KINDS = tuple(GRAMS_PER_KM)
SEVERITY_WEIGHTS = {"fatal": 10, "serious": 5, "other": 1}


def added(columns) -> Column:
    """Sum across columns as BIGINT, which no sum of INTs overflows; NULL if any is NULL."""
    return reduce(add, ((F.col(c) if isinstance(c, str) else c).cast("bigint") for c in columns))


def total_vehicles() -> Column:
    return added(VEHICLE_KINDS)


def quotient(part: Column, base: Column, digits: int) -> Column:
    """Rounded quotient; NULL where the base is 0."""
    return F.round(F.try_divide(part, base), digits)


def percent(part: Column, base: Column) -> Column:
    """Share of the base in percent, 2 decimals; NULL where the base is 0."""
    return F.round(F.try_divide(part, base) * 100, 2)


def row_percent(part: Column, base: Column) -> Column:
    """``percent`` for every row of a large table: the same digits, without a text of the number on the way.

    ``round`` takes halves up in the decimal text of a DOUBLE. Away from a half
    the nearest whole number of hundredths is that result; near one, and for
    what is negative or large, ``round`` itself is asked.
    """
    hundredths = F.try_divide(part, base) * 100 * 100
    near_half = F.abs(hundredths - F.floor(hundredths) - 0.5) < 1e-3
    simple = (hundredths >= 0) & (hundredths < 1e9) & ~near_half
    return F.when(simple, F.floor(hundredths + 0.5) / F.lit(100.0)).otherwise(percent(part, base))


def growth_percent(now: Column, before: Column) -> Column:
    return percent(now - before, before)


def change(now: Column, before: Column, digits: int = 2) -> Column:
    return F.round(now - before, digits)


def green_index(cycles: str, buses: str, total: str) -> Column:
    return percent(F.col(cycles) + F.col(buses), F.col(total))


def as_units(c: Column, digits: int) -> Column:
    """A value with up to ``digits`` decimals as a whole number of its last place; NULL beyond 18 digits."""
    return F.rint(c * 10**digits).try_cast("decimal(18,0)")


def long_units(c: Column, digits: int) -> Column:
    """``as_units`` as BIGINT; the decimal is made of a text, and for the rest only."""
    units = F.rint(c * 10**digits)
    return F.when(F.abs(units) < F.lit(2.0**53), units.cast("bigint")).otherwise(as_units(c, digits).cast("bigint"))


def sum_of_units(units: Column) -> Column:
    """Sum of BIGINT units as a decimal, kept as BIGINT sums of their halves, which 2^32 rows do not overflow."""
    high, low = F.shiftright(units, 31), units.bitwiseAND(F.lit((1 << 31) - 1))
    return F.sum(high).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.sum(low).cast("decimal(20,0)")


def exact_sum(c: Column, digits: int) -> Column:
    """Sum of values with up to ``digits`` decimals, without overflow up to 10^10 of the largest."""
    return sum_of_units(long_units(c, digits)).cast("double") / F.lit(float(10**digits))


def exact_mean(c: Column, digits: int) -> Column:
    """Mean of values with up to ``digits`` decimals; NULL over no values."""
    units = long_units(c, digits)
    return mean_of_units(sum_of_units(units), F.count(units), digits)


def mean_of_units(total: Column, count: Column, digits: int) -> Column:
    return F.try_divide(total.cast("double"), count * F.lit(10**digits))


def co2_hundredths(kind: str) -> Column:
    """CO2 of one trip per vehicle, rounded to 0.01 kg, as a count of 0.01 kg.

    Whole-number form of ``round(n * g_per_km * trip_km / 1000, 2)``: a factor
    in tenths of a km leaves n * g * 128 ten-thousandths of a kg, which is
    rounded to hundreds. Halves cannot occur, as n * g * 128 is a multiple of 4.
    """
    rate = GRAMS_PER_KM[kind] * round(TRIP_KM * 10)
    raised = F.col(kind).cast("bigint") * F.lit(rate) + F.lit(50)
    return ((raised - F.pmod(raised, F.lit(100))) / 100).cast("bigint")


def co2_kg(kind: str) -> Column:
    return co2_hundredths(kind) / F.lit(100.0)


def tonnes(hundredths: Column) -> Column:
    """Tonnes, 2 decimals, from a sum of 0.01 kg."""
    return F.round(hundredths / F.lit(100000.0), 2)


def severity_score(total: Column, fatal: Column, serious: Column) -> Column:
    return (
        fatal * SEVERITY_WEIGHTS["fatal"]
        + serious * SEVERITY_WEIGHTS["serious"]
        + (total - fatal - serious) * SEVERITY_WEIGHTS["other"]
    )


def count_where(test: Column) -> Column:
    return F.count_if(test)
