"""The raw layer: landed feeds into tables with their provenance, refused where pages or too many lines are missing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from viagrid import schemas
from viagrid.session import remove_folder
from viagrid.sources import landed, sinks

#: Share of a feed's lines that may be unreadable.
BAD_SHARE = 0.001


class IncompleteFeed(Exception):
    """A paged feed lacks pages that it announces, or groups that were asked for."""


class UnreadableFeed(Exception):
    """Too many lines of a feed are no documents of its contract."""


@dataclass(frozen=True)
class Feed:
    """Where a feed lies, its record as DDL, and its form: pages, rows, list, csv or parquet.

    ``by`` names the envelope fields, as DDL, that a paged feed is asked for by;
    all pages of each of their values have to be there, and of a page landed
    twice the later one counts. ``asked`` holds the values that were asked for:
    each of them has to have pages. Without ``by`` a paged feed is one group.
    ``text`` keeps every column as text, for feeds of mixed types. Up to
    ``bad_share`` of the lines of a JSON feed may be unreadable.
    """

    path: str
    record: str
    form: str = "list"
    by: str = ""
    escape: str = '"'
    whole_files: bool = False
    text: bool = False
    asked: DataFrame | None = None
    bad_share: float = BAD_SHARE

    @property
    def _record(self) -> str:
        return schemas.as_text(self.record) if self.text else self.record

    @property
    def _groups(self) -> list[str]:
        return [part.split()[0] for part in self.by.split(", ") if part]

    @property
    def documents(self) -> str | None:
        """The contract of a JSON feed's documents; None for other forms."""
        if self.form == "pages":
            return landed.pages_schema(self._record, self.by)
        return {"rows": landed.rows_schema(self._record), "list": self._record}.get(self.form)

    def read(self, spark: SparkSession) -> DataFrame:
        """The records; bad lines are left out."""
        if self.form == "pages":
            return landed.page_records(landed.newest_pages(self.pages(spark), self._groups))
        if self.form == "rows":
            return landed.read_rows(spark, self.path, self._record, whole_files=self.whole_files, skip_bad=True)
        if self.form == "list":
            return landed.read_list(spark, self.path, self._record, self.whole_files, skip_bad=True)
        if self.form == "csv":
            return landed.read_csv(spark, self.path, self._record, self.escape, self.whole_files)
        stored = landed.read_table(spark, self.path)
        return landed.all_text(stored) if self.text else stored

    def pages(self, spark: SparkSession) -> DataFrame:
        return landed.read_pages(spark, self.path, self._record, self.whole_files, self.by, skip_bad=True)

    def bad_lines(self, spark: SparkSession) -> DataFrame:
        return landed.bad_lines(spark, self.path, self.documents, self.whole_files)

    def gaps(self, spark: SparkSession) -> DataFrame:
        """Values of ``by`` whose pages are not all there, and values of ``asked`` without any."""
        pages, by = self.pages(spark), self._groups
        found = landed.page_gaps(pages, by) if self.asked is None or not by else landed.asked_gaps(pages, by, self.asked)
        return found.filter("not coalesce(complete, false)")


def run(spark: SparkSession, feeds: Mapping[str, Feed], base: str) -> DataFrame:
    """Write every feed below ``base``; returns rows, columns and year of each table as read back.

    All feeds are tested first: with a page or a group missing, or too many bad
    lines, nothing is written. Bad lines of a feed that is taken are stored
    beside its table as ``<name>_bad_lines``, which then is part of the report.
    """
    spoilt = []
    for name, feed in feeds.items():
        if feed.documents is not None:
            lines, bad = landed.line_counts(spark, feed.path, feed.documents, feed.whole_files)
            if bad > feed.bad_share * lines:
                raise UnreadableFeed(f"{name}: {bad} of {lines} lines, over a share of {feed.bad_share}")
            if bad:
                spoilt.append(name)
        if feed.form == "pages":
            lacking = feed.gaps(spark).limit(10).collect()
            if lacking:
                raise IncompleteFeed(f"{name}: {[row.asDict() for row in lacking]}")
    paths = {}
    for name, feed in feeds.items():
        paths[name], beside = f"{base}/{name}", f"{base}/{name}_bad_lines"
        sinks.write_table(sinks.with_lineage(feed.read(spark), name), paths[name])
        if name in spoilt:
            paths[f"{name}_bad_lines"] = beside
            sinks.write_table(sinks.with_lineage(feed.bad_lines(spark), name), beside)
        else:
            remove_folder(spark, beside)  # of a load before
    return sinks.written_report(spark, paths)
