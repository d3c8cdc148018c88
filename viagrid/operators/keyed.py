"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep one row for each key.

    Without ``order`` it is the smallest over the remaining columns; with it, the
    one that is highest in those columns, then in the others. A missing value
    loses against any other in either case. NULL keys form a group of their own.

    The rule is total, so the same row is kept on every run. As the first row of
    a window it is found before the shuffle: each task sends at most one row per
    key, however many copies of a key there are.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    if order:
        first = [F.col(name).desc_nulls_last() for name in (*order, *(name for name in rest if name not in order))]
    else:
        first = [F.col(name).asc_nulls_last() for name in rest]
    place = "_place"
    while place in df.columns:
        place = f"_{place}"
    placed = df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*first)))
    return placed.filter(F.col(place) == 1).drop(place)
