"""Fingerprints of contents: equal rows in any order and partitioning give equal prints."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The lower parts of a hash; what is left of its 64 bits, with the sign, is the highest.
BITS = 21


def fingerprints(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One print per group (or of the whole table): rows, and the sum and the exclusive-or of a hash of each row.

    Repeated rows count as often as they occur. Columns are taken by name, so
    their order does not matter; NULL differs from every value. The aggregate
    is partial in each task, one row per group and task is sent. The sum is kept
    as BIGINT sums of the hash's parts, which 2^41 rows do not overflow: a
    decimal per row costs more than the hash.
    """
    columns = sorted(set(df.columns) - set(by))
    row = F.xxhash64(F.lit(1), *(part for name in columns for part in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())))
    hashed = F.col("_row")
    parts = [F.shiftright(hashed, 2 * BITS), F.shiftright(hashed, BITS).bitwiseAND(F.lit((1 << BITS) - 1)), hashed.bitwiseAND(F.lit((1 << BITS) - 1))]
    sums = [F.sum(part).cast("decimal(20,0)") * F.lit(1 << BITS * place).cast("decimal(13,0)") for part, place in zip(parts, (2, 1, 0))]
    total = reduce(add, sums).cast("decimal(38,0)")
    return df.withColumn("_row", row).groupBy(*by).agg(
        F.concat_ws(":", F.count(F.lit(1)), F.coalesce(total, F.lit(0)), F.coalesce(F.bit_xor("_row"), F.lit(0))).alias("fingerprint")
    )
