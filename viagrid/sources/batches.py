"""Tables that streams add to, batch by batch, under a list of live folders.

Each batch writes one folder, named by the stream it came from and its number in
that stream, so no stream can touch what another has brought, not even the same
job after it was given a new checkpoint. A folder counts once the newest list
names it. Lists are numbered and written under a name that must not exist yet, so
of several writers one at a time succeeds; the others look again. A batch that is
tried again replaces its folder until it counts, and changes nothing afterwards.

Small folders are merged, a fixed number of the same level at a time, so a table
of n batches has some log(n) folders and every row is copied log(n) times.
Readers go by the list they have read; merged folders stay until they are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viagrid import session
from viagrid.sources import sinks

#: Folders of a level that are merged into one of the next; lists that are kept.
FAN, KEPT_LISTS = 16, 64
#: The partition column that names a folder.
FOLDER = "_commit"


@dataclass
class Entry:
    """A live folder: its name, how often its rows were merged, its partitions, and the table's mark."""

    name: str
    level: int
    parts: list[str]
    mark: str | None = None


@dataclass
class Listing:
    """What counts at one moment: folders, and the last batch of every stream."""

    version: int = 0
    schema: str | None = None
    live: list[Entry] = field(default_factory=list)
    last: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"schema": self.schema, "last": self.last, "live": [vars(e) for e in self.live]})

    @staticmethod
    def of(version: int, text: str) -> Listing:
        read = json.loads(text)
        return Listing(version, read["schema"], [Entry(**e) for e in read["live"]], read["last"])

    def holds(self, owner: str, number: int) -> bool:
        return self.last.get(owner, -1) >= number


class BatchTable:
    """A table in ``path``, partitioned by ``by`` (which may be empty) within each folder.

    ``mark`` is an aggregate that is noted per folder, as text.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = (), mark: Column | None = None):
        self.spark, self.path, self.by, self.mark = spark, path.rstrip("/"), tuple(by), mark

    def _lists(self) -> str:
        return f"{self.path}/_lists"

    def listing(self) -> Listing:
        """The newest list; an empty one where nothing was added yet."""
        versions = sorted(int(name.removesuffix(".json")) for name in session.names_in(self.spark, self._lists()) if name.endswith(".json"))
        if not versions:
            return Listing()
        return Listing.of(versions[-1], session.read_text(self.spark, f"{self._lists()}/{versions[-1]:020d}.json"))

    def _publish(self, listing: Listing) -> bool:
        """Make this the next list, unless another writer was first."""
        done = session.write_new_text(self.spark, f"{self._lists()}/{listing.version:020d}.json", listing.text())
        if done and listing.version > KEPT_LISTS:
            session.remove_folder(self.spark, f"{self._lists()}/{listing.version - KEPT_LISTS:020d}.json")
        return done

    def read(self, entries: Iterable[Entry] | None = None, parts: set[str] | None = None) -> DataFrame:
        """Rows of the live folders, or of some of them; ``parts`` names values of the first partition column, as ``column=value``.

        Only the folders and partitions asked for are listed.
        """
        listing = self.listing()
        if listing.schema is None:
            raise FileNotFoundError(f"{self.path} has no batch yet")
        chosen = listing.live if entries is None else entries
        paths = [
            f"{self.path}/{FOLDER}={e.name}" + (f"/{part}" if part else "")
            for e in chosen for part in e.parts if parts is None or part.split("/")[0] in parts
        ]
        schema = T.StructType.fromJson(json.loads(listing.schema))
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = schema.add(FOLDER, "string")
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*paths).drop(FOLDER)

    def _write(self, df: DataFrame, name: str, level: int) -> Entry:
        folder = f"{self.path}/{FOLDER}={name}"
        sinks.write_table(df, folder, self.by)
        parts = [""]
        for _ in self.by:
            parts = [f"{p}/{child}".lstrip("/") for p in parts for child in session.names_in(self.spark, f"{folder}/{p}") if "=" in child]
        mark = None
        if self.mark is not None and parts:
            written = self.spark.read.schema(df.schema).option("basePath", folder).parquet(folder)
            mark = written.agg(self.mark.cast("string")).first()[0]
        return Entry(name, level, parts, mark)

    def write(self, df: DataFrame, owner: str, number: int) -> Entry:
        """Write a batch to its folder, replacing what an earlier try has left; it does not count yet."""
        return self._write(df, f"b-{owner}-{number:010d}", 0)

    def count_in(self, entry: Entry, schema: T.StructType, owner: str, number: int, since: Listing | None = None) -> bool:
        """Let a written batch count.

        With ``since`` only if no list was published after that one, so that
        what was written by it still holds; False if there was one.
        """
        while True:
            now = self.listing()
            if now.holds(owner, number):
                return True
            if since is not None and now.version != since.version:
                return False
            live = now.live + ([entry] if entry.parts else [])
            following = Listing(now.version + 1, now.schema or _nullable(schema), live, {**now.last, owner: number})
            if self._publish(following):
                return True

    def add(self, df: DataFrame, owner: str, number: int) -> Entry:
        """Write a batch and let it count; the entry of one that counts already names what it had."""
        now = self.listing()
        name = f"b-{owner}-{number:010d}"
        if now.holds(owner, number):
            return next((e for e in now.live if e.name == name), Entry(name, 0, _partitions(now.live)))
        entry = self.write(df, owner, number)
        self.count_in(entry, df.schema, owner, number)
        return entry

    def merge(self, fan: int = FAN) -> int:
        """Merge ``fan`` folders of a level into one of the next wherever there are as many; returns how many folders went.

        Another writer may merge the same: the second finds them gone and drops its work.
        """
        gone = 0
        while True:
            now = self.listing()
            levels: dict[int, list[Entry]] = {}
            for e in now.live:
                levels.setdefault(e.level, []).append(e)
            ready = [(level, entries[:fan]) for level, entries in sorted(levels.items()) if len(entries) >= fan]
            if not ready:
                return gone
            level, entries = ready[0]
            merged = self._write(self.read(entries), f"m-{uuid.uuid4().hex}", level + 1)
            names = {e.name for e in entries}
            while True:
                now = self.listing()
                if not names <= {e.name for e in now.live}:
                    session.remove_folder(self.spark, f"{self.path}/{FOLDER}={merged.name}")
                    break
                live = [merged, *(e for e in now.live if e.name not in names)]
                if self._publish(Listing(now.version + 1, now.schema, live, now.last)):
                    gone += len(names) - 1
                    break

    def remove_merged(self) -> int:
        """Remove folders that no kept list names: what was merged long ago, and what broken-off merges have left.

        Call it when no reader, no stream over the folders and no merge is
        running. Folders of batches that do not count yet belong to their
        streams and stay.
        """
        named = set()
        for name in session.names_in(self.spark, self._lists()):
            if name.endswith(".json"):
                named |= {e.name for e in Listing.of(0, session.read_text(self.spark, f"{self._lists()}/{name}")).live}
        last = self.listing().last
        removed = 0
        for child in session.names_in(self.spark, self.path):
            name = child.removeprefix(f"{FOLDER}=")
            if name == child or name in named:
                continue
            owner, _, number = name.removeprefix("b-").rpartition("-")
            if name.startswith("m-") or last.get(owner, -1) >= int(number):
                session.remove_folder(self.spark, f"{self.path}/{child}")
                removed += 1
        return removed


def _nullable(schema: T.StructType) -> str:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).json()


def _partitions(live: Iterable[Entry]) -> list[str]:
    return sorted({part for e in live for part in e.parts})
