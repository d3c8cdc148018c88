"""Casts, text rules and filters for turning raw columns into typed ones.

A contract maps a column to a rule ``Column -> Column``; ``conform`` applies it
in one projection. Casts never raise: what does not parse becomes NULL, also
where ANSI mode is on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = Callable[[Column], Column]

# The area and the years the counts may lie in, ends included.
LATITUDES = (49.0, 61.0)
LONGITUDES = (-8.0, 2.0)
FIRST_COUNT_YEAR = 2000


def whole(c: Column) -> Column:
    """INT from text that is a number as a whole; its fraction is cut off.

    ``837.0`` and ``1.5e3`` are numbers, ``12.abc`` and ``7.8.9`` are not. What
    is whole as it stands, as nearly all counts are, takes the short way; the
    decimal is made for the rest only. A cast that fails inside raises and
    catches an error, which costs as much as a hundred that do not: text with a
    point is no INT and goes to the decimal at once, text that begins with a
    letter (``None``, ``nan``) is neither. The two conditions side by side make
    less code than one within the other: the annual silver stage has to stay
    under the limit on generated methods.
    """
    word = (c >= "A") & (c < "{")  # the ASCII letters and the signs between them
    plain = F.when(~(word | F.contains(c, F.lit("."))), c.try_cast("int"))
    return F.coalesce(plain, F.when(~word, c.try_cast("decimal(38,18)").try_cast("int")))


def whole_number(c: Column) -> Column:
    """INT from a numeric column."""
    return c.try_cast("int")


def real(c: Column) -> Column:
    """DOUBLE, with NaN (the text ``nan``) and both infinities as NULL so that they spoil no sum."""
    return F.when(F.abs(place(c)) < F.lit(float("inf")), place(c))


def place(c: Column) -> Column:
    """DOUBLE for a coordinate; NaN lies outside any bounds and needs no rule."""
    return c.try_cast("double")


def stripped(c: Column) -> Column:
    return F.trim(c)


def capitals(c: Column) -> Column:
    return F.upper(stripped(c))


def title_case(c: Column) -> Column:
    return F.initcap(stripped(c))


def day(fmt: str) -> Rule:
    """DATE from text in ``fmt``; NULL where it does not parse."""
    return lambda c: F.try_to_timestamp(c.cast("string"), F.lit(fmt)).cast("date")


def moment(c: Column) -> Column:
    return c.try_cast("timestamp")


def conform(df: DataFrame, contract: Mapping[str, Rule]) -> DataFrame:
    """Apply a rule to each column of the contract, in one projection."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    columns = {}
    for name, rule in contract.items():
        if rule is whole and name not in text:
            rule = whole_number
        columns[name] = rule(F.col(name))
    return df.withColumns(columns)


def within_years(first: int | None = FIRST_COUNT_YEAR, last: int | None = None, name: str = "year") -> Column:
    """Whether a year lies in a window, ends included; None leaves that side open."""
    year = F.col(name)
    test = year.isNotNull()
    if first is not None:
        test &= year >= first
    if last is not None:
        test &= year <= last
    return test


def within_area(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    return F.col(latitude).between(*LATITUDES) & F.col(longitude).between(*LONGITUDES)


def all_present(*names: str) -> Column:
    test = F.col(names[0]).isNotNull()
    for name in names[1:]:
        test &= F.col(name).isNotNull()
    return test
