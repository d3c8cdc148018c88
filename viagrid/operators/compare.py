"""Comparison with the period before and with a fixed base period.

The windows run on aggregated rows, one per period and group, so a window group
holds no more rows than there are years.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viagrid.functions import metrics


def previous(value: str, by: Sequence[str], order: str = "year", strict: bool = False) -> Column:
    """The value of the period before within each group.

    That is the last period present; with ``strict`` only the directly
    preceding one counts, and a gap gives NULL.
    """
    window = Window.partitionBy(*by).orderBy(order)
    before = F.lag(value).over(window)
    if strict:
        before = F.when(F.lag(order).over(window) == F.col(order) - 1, before)
    return before


def with_growth(
    df: DataFrame, value: str, by: Sequence[str], previous_name: str, growth_name: str,
    strict: bool = False,
) -> DataFrame:
    """Add the previous value and the growth over it in percent."""
    return df.withColumn(previous_name, previous(value, by, strict=strict)).withColumn(
        growth_name, metrics.growth_percent(F.col(value), F.col(previous_name))
    )


def with_change(
    df: DataFrame, value: str, by: Sequence[str], previous_name: str, change_name: str,
    strict: bool = False,
) -> DataFrame:
    """Add the previous value and the difference from it."""
    return df.withColumn(previous_name, previous(value, by, strict=strict)).withColumn(
        change_name, metrics.change(F.col(value), F.col(previous_name))
    )


def base_value(value: str, by: Sequence[str], base_period: int, period: str = "year") -> Column:
    """The group's value in the base period, NULL where it has none.

    Same result as a left join with the base period's rows, but it shares the
    shuffle of the other windows over the group. A NULL group key finds no base.
    """
    window = Window.partitionBy(*by)
    base = F.max(F.when(F.col(period) == base_period, F.col(value))).over(window)
    known = F.col(by[0]).isNotNull()
    for name in by[1:]:
        known &= F.col(name).isNotNull()
    return F.when(known, base)
