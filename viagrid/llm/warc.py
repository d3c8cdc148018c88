"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames; a seek table in a skippable frame
closes each file, and an index maps every record to its frame and to the offset
inside the frame. Of records with equal payloads one is a response, the others
are revisits that refer to it and carry no payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viagrid.llm.components import stored
from viagrid.llm.files import create, new_name, opened
from viagrid.session import work_folder

#: Bytes of records after which a frame, and of frames after which a file is closed.
FRAME_BYTES, FILE_BYTES = 1 << 20, 1 << 30
#: Bytes of records that a task reads back, about.
READ_BYTES = 1 << 26
#: Fixed values of the seekable format: skippable frame, end of the seek table.
SKIPPABLE, SEEK_END = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:example:page:"
_INDEX = pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit if it refers to another page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{NAME}{'' if page_id is None else page_id}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{NAME}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of a record; a response's digest is verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if version != "WARC/1.1" or len(rest) != int(fields["Content-Length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    own, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest(payload) != own):
        raise ValueError("a payload differs from its digest")

    def page(name: str) -> int | None:
        number = fields.get(name, "").strip("<>").removeprefix(NAME)
        return int(number) if number else None

    return {"page_id": page("WARC-Record-ID"), "payload_bytes": size, "payload_digest": own, "record_type": kind, "refers_to": page("WARC-Refers-To")}


class Bundle:
    """Writes records into frames of one file."""

    def __init__(self, name: str):
        self.name, self.out, self.sizes, self.rows, self.held, self.n = name, create(name), [], [], [], 0

    def add(self, page_id: int | None, data: bytes) -> None:
        self.rows.append((page_id, self.name, len(self.sizes), self.n, len(data)))
        self.held.append(data)
        self.n += len(data)
        if self.n >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.held:
            frame = zstandard.ZstdCompressor(level=3).compress(b"".join(self.held))
            self.out.write(frame)
            self.sizes.append((len(frame), self.n))
            self.held, self.n = [], 0

    def written(self) -> int:
        return sum(a for a, _ in self.sizes)

    def close(self) -> list[tuple]:
        self.end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEK_END)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        return self.rows


class Archive:
    """Reads records of a bundle by frame and offset."""

    def __init__(self, name: str):
        self.file = opened(name)
        size = self.file.size()
        count, flags, mark = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if mark != SEEK_END or flags & 0x80:
            raise ValueError("no seek table")
        entries = struct.iter_unpack("<II", self.file.read_at(8 * count, size - 9 - 8 * count))
        self.places, at = [], 0
        for packed, whole in entries:
            self.places.append((at, packed, whole))
            at += packed
        self.at, self.frame = -1, b""

    def read(self, frame: int, offset: int, length: int) -> bytes:
        if frame != self.at:
            place, packed, whole = self.places[frame]
            self.frame = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, place), max_output_size=whole)
            self.at = frame
        return self.frame[offset : offset + length]

    def close(self) -> None:
        self.file.close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _INDEX.types)], schema=_INDEX)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
            for row in zip(*columns):
                page, url, payload, refers = (v.as_py() for v in row)
                bundle = bundle or Bundle(new_name(folder, "pages", ".warc.zst"))
                bundle.add(page, record(page, url, payload.encode(), refers))
                if bundle.written() >= FILE_BYTES:
                    yield _batch(bundle.close())
                    bundle = None
        if bundle:
            yield _batch(bundle.close())

    return run


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to: the largest page_id with an equal payload, null for that page itself.

    Payloads are compared by SHA-256 and length. Payloads under ``least_bytes``
    refer to none.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"same": F.sha2(F.encode("payload", "UTF-8"), 256), "bytes": F.octet_length("payload")})
    firsts = rows.groupBy("same", "bytes").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where(F.col("n") > 1).select("same", "bytes", "first")
    other = (F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, ["same", "bytes"], "left").select("page_id", "url", "payload", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages``; returns the index: page_id, file, frame, offset, length.

    A null html is an empty payload, a null url has no target line, a null
    page_id a name without number. Rows that repeat the response's page_id are
    responses too. No rows write no file.
    """
    spark = pages.sparkSession
    kind = "page_id long, file string, frame int, offset long, length long"
    return stored(spark, with_references(pages, least_bytes).mapInArrow(_write(work_folder(spark, "archives")), kind), "archive-index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    archive, name = None, None
    kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    for batch in batches:
        found = []
        for file, frame, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "frame", "offset", "length"))):
            if file != name:
                if archive:
                    archive.close()
                archive, name = Archive(file), file
            found.append(parsed(archive.read(frame, offset, length)))
        yield pa.RecordBatch.from_pylist(found, schema=kinds)
    if archive:
        archive.close()


def read_archives(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record, read at its place in its file.

    The records are parted by the bytes they inflate to, not by the size of the index.
    """
    whole = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(index.sparkSession.sparkContext.defaultParallelism, -(-whole // READ_BYTES))
    ordered = index.repartition(parts, "file", "frame").sortWithinPartitions("file", "frame", "offset")
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return ordered.select("file", "frame", "offset", "length").mapInArrow(_read, kind)
