"""Rows that break rules, kept apart.

Each row gets a mask, one bit per rule it breaks, once. The report, the good rows
and the rejected ones all follow from the masked table, so they cannot disagree:
good rows and rejected rows together are the input.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viagrid.operators import quality
from viagrid.session import remove_folder
from viagrid.sources import sinks

#: The mask, and in rejected rows the names of the broken rules.
MASK, BROKEN = "_rules_broken", "broken_rules"
MOST_RULES = 63


def with_mask(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows with their mask; a test that is NULL counts as no violation."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"over {MOST_RULES} rules")
    mask = F.lit(0).cast("bigint")
    for bit, test in enumerate(rules.values()):
        mask = mask.bitwiseOR(F.when(test, F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
    return df.withColumn(MASK, mask)


def _breaks(bit: int) -> Column:
    return F.col(MASK).bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0


def report_of(masked: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Violations of each rule, as ``quality.check_rows`` gives them; of a stored table only the mask is read."""
    return quality.check_rows(masked, table, {rule: _breaks(bit) for bit, rule in enumerate(rules)})


def good_rows(masked: DataFrame) -> DataFrame:
    return masked.filter(F.col(MASK) == 0).drop(MASK)


def rejected_rows(masked: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break any rule, with the names of those."""
    names = F.array(*(F.when(_breaks(bit), F.lit(rule)) for bit, rule in enumerate(rules))) if rules else F.array().cast("array<string>")
    return masked.filter(F.col(MASK) != 0).withColumn(BROKEN, F.array_compact(names)).drop(MASK)


@dataclass(frozen=True)
class Gate:
    """What a run tolerates: the share of a table's rows that may break a rule, of some rules by name; and the years that counts may lie in."""

    most: float = 0.01
    shares: Mapping[str, float] = field(default_factory=dict)
    first_year: int = 2000
    last_year: int | None = None

    def rules(self, df: DataFrame, table: str) -> dict[str, Column]:
        return quality.rules_of(table, df.columns, self.first_year, self.last_year)

    def check(self, report: DataFrame) -> None:
        """Stop where a rule is broken by more rows than that."""
        broken = [r for r in report.collect() if r.violations > self.shares.get(r.rule, self.most) * r.total]
        if broken:
            raise quality.RuleViolated("; ".join(f"{r.table_name} {r.rule}: {r.violations} of {r.total}" for r in broken))


@dataclass(frozen=True)
class Checked:
    """A table that has passed a gate: its masked rows as stored, and its rules."""

    table: str
    masked: DataFrame
    rules: dict[str, Column]

    @property
    def good(self) -> DataFrame:
        return good_rows(self.masked)

    @property
    def rejected(self) -> DataFrame:
        return rejected_rows(self.masked, self.rules)

    @property
    def report(self) -> DataFrame:
        return report_of(self.masked, self.table, self.rules)


def checked(spark: SparkSession, df: DataFrame, table: str, gate: Gate, kept: str) -> Checked:
    """The table computed once, with its mask, into ``kept``, and held against the gate before anything else is written."""
    rules = gate.rules(df, table)
    sinks.write_table(with_mask(df, rules), kept)
    out = Checked(table, spark.read.parquet(kept), rules)
    gate.check(out.report)
    return out


def put_aside(spark: SparkSession, found: Checked, path: str) -> None:
    """Replace a table's rejected rows; no folder where there are none."""
    if found.rejected.isEmpty():
        remove_folder(spark, path)
    else:
        sinks.write_table(found.rejected, path)
