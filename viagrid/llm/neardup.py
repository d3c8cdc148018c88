"""Near-duplicates: universal hash minima, banding, verification, connected components.

Documents with the same set of word shingles form a class, stood for by its
smallest id. Classes that share a band meet in buckets. First every class is
held against the smallest it meets, by signature and then on the full
shingle sets, and what links is joined; this takes a family of near copies
together without comparing it all against all. In buckets that still hold
classes of several components, each pair of different ones is then compared once
(in the first band that both share). Only edges that join what was apart leave a
task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viagrid.llm.components import components, stored
from viagrid.llm.text import seeded, shingle_sets

#: Bands and minima in each: a pair at similarity 0.8 shares no band with probability 5e-8, at 0.85 with 5e-11.
BANDS, ROWS = 32, 4
#: Members of a bucket that one task compares; larger buckets are compared as pairs of blocks.
BLOCK = 1024
#: Standard deviations of the signature estimate below the threshold that are still verified.
SLACK = 5.0

_FACTORS = seeded(BANDS * ROWS, 10) | np.uint64(1)
_SHIFTS = seeded(BANDS * ROWS, 11)
_WIDTH = 2 * ROWS  # bytes of a band in a signature


def signature(shingles: np.ndarray) -> bytes:
    """The low 16 bits of each multiply-shift hash's minimum over a set."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 1024):
        values = _FACTORS[:, None] * shingles[None, i : i + 1024] + _SHIFTS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(24)).astype("<u2").tobytes()


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("sig", pa.binary())])
    for batch in batches:
        sizes, keys, marks = [], [], []
        for shingles in shingle_sets(batch.column(1)):
            sizes.append(len(shingles))
            keys.append(set_key(shingles))
            marks.append(signature(shingles) if len(shingles) else b"")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary())], schema=schema
        )


def groups_of(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal values in the first ``n_keys`` columns of sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(k)) for k in range(n_keys)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(keys[a])
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)


def _marks(table: pa.Table, name: str) -> np.ndarray:
    joined = b"".join(table.column(name).to_pylist())
    return np.frombuffer(joined, dtype="<u2").reshape(-1, BANDS * ROWS)


def _alike(i: int, marks: np.ndarray, bands: np.ndarray, band: int, least: float) -> np.ndarray:
    """Members after ``i`` whose signature is near enough and whose first shared band is ``band``."""
    first = bands[i + 1 :] == bands[i]
    rows = np.flatnonzero(first[:, band] & ~first[:, :band].any(axis=1)) + i + 1
    if not len(rows):
        return rows
    return rows[(marks[rows] == marks[i]).mean(axis=1) >= least]


def _across(part: np.ndarray, lo: int, hi: int, i: int, rows: np.ndarray) -> np.ndarray:
    """Of ``rows``, those that lie in the other block than ``i`` where two blocks meet."""
    return rows if lo == hi else rows[part[rows] != part[i]]


def _least_estimate(threshold: float) -> float:
    """Share of equal minima from which on a pair is verified."""
    return threshold - SLACK * (threshold * (1 - threshold) / (BANDS * ROWS)) ** 0.5


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets are similar enough, exactly."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _sets(group: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    """The rows whose text is that of their class, with its shingles; an id may come with several texts."""
    keys = group.column("key").to_pylist()
    found = [(at, shingles) for at, shingles in enumerate(shingle_sets(group.column("text").combine_chunks())) if set_key(shingles) == keys[at]]
    return group.take(pa.array([at for at, _ in found], pa.int64())), [shingles for _, shingles in found]


def _near_first(threshold: float):
    """The first member of each group, and those whose signature is near its own."""
    least = _least_estimate(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups_of(batches, 2):
            marks = _marks(group, "sig")
            near = (marks == marks[0]).mean(axis=1) >= least
            if near.sum() > 1:
                yield from group.filter(pa.array(near)).combine_chunks().to_batches()

    return run


def _first_edges(percent: int):
    """Edges between the first member of each group and those that are similar enough on full sets."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (least, _), group in groups_of(batches, 2):
            group, sets = _sets(group)
            ids = np.asarray(group.column("rep"))
            first = next((s for k, s in zip(ids, sets) if k == least), None)
            if first is None:
                continue
            v = [k for k, s in zip(ids, sets) if k != least and _linked(first, s, percent)]
            if v:
                yield pa.RecordBatch.from_arrays([pa.array([least] * len(v), pa.int64()), pa.array(v, pa.int64())], schema=schema)

    return run


def _promising(threshold: float):
    """Members of each bucket (or pair of blocks) that have a partner of another component to verify."""
    least = _least_estimate(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lo, hi), group in groups_of(batches, 3):
            if len(group) < 2:
                continue
            marks, part, root = _marks(group, "sig"), np.asarray(group.column("part")), np.asarray(group.column("root"))
            if (root == root[0]).all():
                continue
            bands, band = np.ascontiguousarray(marks).view("<u8").reshape(-1, BANDS), int(group.column("band")[0].as_py())
            wanted = np.zeros(len(group), dtype=bool)
            for i in range(len(group) - 1):
                rows = _across(part, lo, hi, i, _alike(i, marks, bands, band, least))
                rows = rows[root[rows] != root[i]]
                if len(rows):
                    wanted[i] = True
                    wanted[rows] = True
            if wanted.any():
                yield from group.filter(pa.array(wanted)).combine_chunks().to_batches()

    return run


def _edges(percent: int):
    """Edges that join the components of a group's members: pairs at ``percent`` or more on full sets."""
    least = _least_estimate(percent / 100)
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lo, hi), group in groups_of(batches, 3):
            group, sets = _sets(group)
            if len(sets) < 2:
                continue
            part, marks, outer = np.asarray(group.column("part")), _marks(group, "sig"), np.asarray(group.column("root"))
            bands, band = np.ascontiguousarray(marks).view("<u8").reshape(-1, BANDS), int(group.column("band")[0].as_py())
            root = np.unique(outer, return_inverse=True)[1]
            u, v = [], []
            for i in range(len(sets) - 1):
                for j in _across(part, lo, hi, i, _alike(i, marks, bands, band, least)):
                    if root[i] != root[j] and _linked(sets[i], sets[j], percent):
                        root[root == root[j]] = root[i]
                        u.append(outer[i])
                        v.append(outer[j])
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)

    return run


def _buckets(classes: DataFrame) -> DataFrame:
    """(bucket, band, rep) of every class and band."""
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    rows = classes.select("rep", "sig", band.alias("band"))
    key = F.xxhash64("band", F.expr(f"substring(sig, band * {_WIDTH} + 1, {_WIDTH})"))
    return rows.select(key.alias("bucket"), F.col("band").cast("int").alias("band"), "rep")


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows of a bucket of ``n`` members, once for each pair of blocks they belong to."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    rows = rows.withColumn("part", F.when(blocks == 1, 0).otherwise(F.pmod(F.xxhash64("rep", F.lit(7)), blocks)).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    lo, hi = F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")
    return rows.select("bucket", lo, hi, "band", "part", "rep", "root")


def _with_first(rows: DataFrame, block: int) -> DataFrame:
    """(first, part, rep): each member with the smallest one in any of its buckets, in parts of about ``block`` that have the first in them."""
    first = rows.groupBy("bucket").agg(F.min("rep").alias("first"))
    pairs = rows.join(first, "bucket").groupBy("rep").agg(F.min("first").alias("first")).where("rep <> first")
    sizes = pairs.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("rep", F.lit(7)), "parts").cast("int").alias("part")
    own = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    return pairs.join(sizes, "first").select("first", part, "rep").union(sizes.select("first", own, F.col("first").alias("rep")))


def _grouped(df: DataFrame, run, schema: str, keys: tuple[str, ...] = ("bucket", "lo", "hi")) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInArrow(run, schema)


def near_duplicates(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Two documents are linked if ``100 * shared >= percent * union`` of their
    five-word shingles (A-Z folded). A null or empty text has an empty set and no
    link; a text of fewer than five words has its whole sequence as one shingle.
    Rows with a null id, and ids without a link, are alone; a repeated row is in
    the component of its id. Other columns are ignored; no rows give no rows.
    """
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketches = stored(spark, texts.mapInArrow(_sketch, "id long, n long, key binary, sig binary"), "sketches")
    first = sketches.where("n > 0 and id is not null").groupBy("key").agg(F.min(F.struct("id", "sig")).alias("m"))
    classes = stored(spark, first.select("key", F.col("m.id").alias("rep"), F.col("m.sig").alias("sig")), "classes")

    texts = texts.withColumnRenamed("id", "rep")
    rows = _buckets(classes)
    crowds = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    rows = stored(spark, rows.join(crowds, "bucket"), "buckets")

    held = _with_first(rows, block).join(classes, "rep").select("first", "part", "rep", "key", "sig")
    near = stored(spark, _grouped(held, _near_first(percent / 100), "first long, part int, rep long, key binary, sig binary", ("first", "part")), "near-first")
    with_text = near.drop("sig").join(texts, "rep").select("first", "part", "rep", "key", "text")
    joined_once = components(spark, _grouped(with_text, _first_edges(percent), "u long, v long", ("first", "part")))
    joined_once = stored(spark, joined_once.select(F.col("node").alias("rep"), "root"), "joined-once")

    rows = rows.join(joined_once, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    mixed = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a <> _b").select("bucket", "n")
    members = _in_blocks(rows.join(mixed, "bucket"), block)
    kind = "bucket long, lo int, hi int, band int, part int, rep long, root long, key binary, sig binary"
    placed = members.join(classes, "rep").select("bucket", "lo", "hi", "band", "part", "rep", "root", "key", "sig")
    promising = stored(spark, _grouped(placed, _promising(percent / 100), kind), "promising")
    columns = ("bucket", "lo", "hi", "band", "part", "rep", "root", "key", "sig", "text")
    edges = _grouped(promising.join(texts, "rep").select(*columns), _edges(percent), "u long, v long")

    joined_twice = components(spark, edges).select(F.col("node").alias("once"), F.col("root").alias("twice"))
    named = classes.select("key", "rep").join(joined_once, "rep", "left").select("key", F.coalesce("root", "rep").alias("once"))
    named = named.join(joined_twice, "once", "left").select("key", F.coalesce("twice", "once").alias("root"))
    joined = sketches.join(named, "key", "left")
    component: Column = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component, one row per id.

    Rows with a null id stay, as nothing can stand for them.
    """
    found = near_duplicates(docs, percent, id_col, text_col)
    keep = found.where(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__kept")).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(keep, F.col(id_col).cast("long") == F.col("__kept")).drop("__kept")
    order = F.struct(*(F.col(c) for c in docs.columns if c != id_col)) if len(docs.columns) > 1 else F.lit(0)
    rank = F.row_number().over(Window.partitionBy(id_col).orderBy(order))
    one = named.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    return one.unionByName(docs.where(F.col(id_col).isNull()))
