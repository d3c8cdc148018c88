"""Token ids in wavelet matrices: one compressed file per shard.

A shard holds its ids as bit-planes, highest bit first; from plane to plane the
ids are dealt stably into zeros and ones. Planes are cut into blocks that are
compressed on their own, and the directory keeps how many ones come before each
block. Reading an id, counting one in a range or finding an occurrence touches
one block per plane.

File: blocks, then the compressed directory, then its place and size and a mark.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viagrid.llm.components import stored
from viagrid.llm.files import create, new_name, opened
from viagrid.llm.tokens import encoder
from viagrid.session import work_folder

MARK = b"WVMATRX1"
#: Bits in a block, and ids in a shard before the next one begins.
BLOCK_BITS, SHARD_IDS = 1 << 16, 4 << 20
_BLOCK_BYTES = BLOCK_BITS // 8
_FOOTER = struct.Struct("<QQ8s")


def written(out, ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, starts: np.ndarray) -> None:
    """Write a shard: ids of its documents one after another, each document's id and first place."""
    levels = max(1, int(ids.max()).bit_length() if len(ids) else 1)
    kind = np.uint16 if levels <= 16 else np.uint32
    now, press, place = ids.astype(kind), zstandard.ZstdCompressor(level=1), 0
    zeros, ranks, offsets = [], [], [0]
    for level in range(levels):
        ones = (now >> kind(levels - 1 - level)).astype(np.uint8) & 1
        packed = np.packbits(ones, bitorder="little")
        before = [0]
        for i in range(0, len(packed), _BLOCK_BYTES):
            block = packed[i : i + _BLOCK_BYTES]
            frame = press.compress(block.tobytes())
            out.write(frame)
            place += len(frame)
            offsets.append(place)
            before.append(before[-1] + int(np.bitwise_count(block).sum()))
        ranks.append(before)
        zeros.append(len(now) - before[-1])
        flags = ones.view(bool)
        now = np.concatenate((now[~flags], now[flags]))
    directory = io.BytesIO()
    np.savez(
        directory, n=np.array([len(ids), levels]), zeros=np.array(zeros), ranks=np.array(ranks, np.int64), offsets=np.array(offsets, np.int64),
        doc_ids=doc_ids.astype(np.int64), nulls=nulls.astype(bool), starts=starts.astype(np.int64),
    )
    body = press.compress(directory.getvalue())
    out.write(body)
    out.write(_FOOTER.pack(place, len(body), MARK))


class Shard:
    """A shard file: ids by place, counts and occurrences without reading it whole."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        place, length, mark = _FOOTER.unpack(file.read_at(_FOOTER.size, size - _FOOTER.size))
        if mark != MARK:
            raise ValueError("not a wavelet shard")
        found = np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(file.read_at(length, place))))
        self.n, self.levels = map(int, found["n"])
        self.zeros, self.ranks, self.offsets = found["zeros"], found["ranks"], found["offsets"]
        self.doc_ids, self.nulls, self.starts = found["doc_ids"], found["nulls"], found["starts"]
        self.blocks = (len(self.offsets) - 1) // self.levels
        self.held: dict[tuple[int, int], np.ndarray] = {}

    def _block(self, level: int, k: int) -> np.ndarray:
        """The bits of a block; the latest few hundred are kept."""
        if (level, k) not in self.held:
            if len(self.held) >= 256:
                self.held.clear()
            at = level * self.blocks + k
            a, b = int(self.offsets[at]), int(self.offsets[at + 1])
            raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(b - a, a), max_output_size=_BLOCK_BYTES)
            self.held[level, k] = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
        return self.held[level, k]

    def _ones(self, level: int, i: int) -> int:
        """Ones before place i of a plane."""
        k, rest = divmod(i, BLOCK_BITS)
        return int(self.ranks[level, k]) + (int(self._block(level, k)[:rest].sum()) if rest else 0)

    def _place_of(self, level: int, rank: int, bit: int) -> int:
        """Where in a plane the rank-th (from 0) bit of that value stands."""
        before = self.ranks[level] if bit else np.minimum(np.arange(self.blocks + 1) * BLOCK_BITS, self.n) - self.ranks[level]
        k = int(np.searchsorted(before, rank, "right")) - 1
        width = min(BLOCK_BITS, self.n - k * BLOCK_BITS)
        return k * BLOCK_BITS + int(np.flatnonzero(self._block(level, k)[:width] == bit)[rank - int(before[k])])

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for level in range(self.levels):
            k, rest = divmod(i, BLOCK_BITS)
            bit, ones = int(self._block(level, k)[rest]), self._ones(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, a: int, b: int) -> tuple[int, int]:
        """Where the occurrences of an id in places a to b stand after the last plane."""
        if token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            low, high = self._ones(level, a), self._ones(level, b)
            if token >> (self.levels - 1 - level) & 1:
                a, b = int(self.zeros[level]) + low, int(self.zeros[level]) + high
            else:
                a, b = a - low, b - high
        return a, b

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """Occurrences of an id in places a to b."""
        low, high = self._range(token, a, self.n if b is None else b)
        return high - low

    def occurrence(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of an id."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError("no such occurrence")
        at = low + k
        for level in reversed(range(self.levels)):
            bit = token >> (self.levels - 1 - level) & 1
            at = self._place_of(level, at - int(self.zeros[level]) if bit else at, bit)
        return at

    def whole(self) -> np.ndarray:
        """All ids in order, plane by plane from the last."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for level in reversed(range(self.levels)):
            a, b = self.offsets[level * self.blocks], self.offsets[(level + 1) * self.blocks]
            raw = self.file.read_at(int(b - a), int(a))
            frames, bits = self.offsets[level * self.blocks : (level + 1) * self.blocks + 1] - a, []
            press = zstandard.ZstdDecompressor()
            for x, y in zip(frames, frames[1:]):
                bits.append(press.decompress(raw[x:y], max_output_size=_BLOCK_BYTES))
            flags = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8), bitorder="little")[: self.n].view(bool)
            zeros, dealt = int(self.zeros[level]), np.empty(self.n, kind)
            dealt[~flags] = values[:zeros]
            dealt[flags] = values[zeros:] | kind(1 << (self.levels - 1 - level))
            values = dealt
        return values


class _Writer:
    """Gathers the ids of a partition's documents and writes a shard whenever it is full."""

    def __init__(self, folder: str, part: int):
        self.folder, self.part, self.seq = folder, part, 0
        self.clear()

    def clear(self) -> None:
        self.ids: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.starts: list[int] = []
        self.n = 0

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append(doc)
        self.starts.append(self.n)
        self.ids.append(ids)
        self.n += len(ids)
        if self.n >= SHARD_IDS:
            yield self.flush()

    def flush(self) -> tuple:
        name = new_name(self.folder, f"shard-{self.part:06d}-{self.seq:04d}", ".wvm")
        with create(name) as out:
            docs = np.array([d or 0 for d in self.docs], np.int64)
            written(out, np.concatenate(self.ids), docs, np.array([d is None for d in self.docs]), np.array(self.starts))
        row = (self.part, self.seq, name, len(self.docs), self.n)
        self.seq += 1
        self.clear()
        return row


_SHARDS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _write(path: str, end: int, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer, tail = _Writer(folder, TaskContext.get().partitionId()), np.array([end], np.uint32)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            rows = []
            for i, ids, bounds in encoder(path).encoded(batch.column(1)):
                for k in range(len(bounds) - 1):
                    rows += writer.add(docs[i + k], np.concatenate((ids[bounds[k] : bounds[k + 1]], tail)))
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(_SHARDS.names, r)) for r in rows], schema=_SHARDS)
        if writer.n:
            yield pa.RecordBatch.from_pylist([dict(zip(_SHARDS.names, writer.flush()))], schema=_SHARDS)

    return run


def write_shards(docs: DataFrame, path: str, end: int = 1) -> DataFrame:
    """Encode all documents, each followed by ``end``, into shards by ascending doc_id; returns the table of shards.

    part and seq give the order of the shards; null ids come first, rows that
    share an id by their text. A null or empty text has the end id alone; no rows
    give no shards. Texts are shuffled once, by ranges of ids.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    kind = "part int, seq int, file string, n_docs long, n_ids long"
    return stored(spark, ordered.mapInArrow(_write(path, end, work_folder(spark, "shards")), kind), "shard-table")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
            with opened(name) as file:
                shard = Shard(file)
                ids, bounds = shard.whole().astype("<u4"), np.append(shard.starts, shard.n)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
            columns = [pa.array(shard.doc_ids, mask=shard.nulls), pa.array(shard.starts + first), pa.array(np.diff(bounds)), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids before it in all shards), n_tokens and ids_crc32 of every document, from the files."""
    order = Window.orderBy("part", "seq")
    first = F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = shards.withColumn("first", F.coalesce(first, F.lit(0)))
    spread = placed.repartition(max(1, shards.count()), "file")
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
