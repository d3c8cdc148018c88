"""Benchmark decontamination: size-partitioned MinHash containment search.

The sketch of a test item is the set of its minima under several universal hash
functions; a document that contains the item contains most of them, however long
it is. Items are partitioned by size: each size class has as many hash functions
as it takes for every sketch to hold more shingles than a matching document may
lack, so a match always shares part of the sketch. Candidates are verified on
the item's full shingle set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viagrid.llm.text import CHUNK_BYTES, by_bytes, seeded, shingle_hashes, shingle_sets, words_of

#: Item shingles that one pass broadcasts (8 bytes each, and 12 for sketches); more items take more passes.
PASS_SHINGLES = 1_000_000
#: Hash functions of the smallest size class; each doubling of the size doubles them.
LEAST_HASHES = 16


def sketch(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The item's minima: more distinct shingles than a document at ``percent`` may lack."""
    size_class = int(len(shingles)).bit_length()
    needed = len(shingles) * (100 - percent) // 100 + 1
    wanted, found, seed = max(LEAST_HASHES, 1 << max(0, size_class - 1)), np.empty(0, np.uint64), 0
    while True:
        factors, shifts = seeded(wanted, 100 + seed) | np.uint64(1), seeded(wanted, 200 + seed)
        least = []
        for a, b in zip(factors, shifts):
            least.append(shingles[np.argmin(shingles * a + b)])
        found = np.union1d(found, np.array(least, dtype=np.uint64))
        if len(found) >= needed:
            return found
        seed += 1


@dataclass
class Sketches:
    """Items of one pass: ids, full sets, and the sketches turned into an index shingle -> items."""

    ids: list[int]
    sets: list[np.ndarray]
    least: np.ndarray  # shared sketch shingles that make an item a candidate
    shingles: np.ndarray
    first: np.ndarray
    items: np.ndarray


def index_of(items: list[tuple[int, np.ndarray]], percent: int) -> Sketches:
    sketches = [sketch(s, percent) for _, s in items]
    flat = np.concatenate([*sketches, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(items)), [len(s) for s in sketches]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    shingles, first = np.unique(flat[order], return_index=True)
    least = np.array([len(k) - len(s) * (100 - percent) // 100 for k, (_, s) in zip(sketches, items)], dtype=np.int64)
    return Sketches([i for i, _ in items], [s for _, s in items], least, shingles, np.append(first, len(flat)), owner[order])


def matches(found: np.ndarray, index: Sketches, percent: int) -> list[tuple[int, int]]:
    """(item, shared shingles) of the items that a document's shingle set contains."""
    at = np.searchsorted(index.shingles, found)
    hit = at[(at < len(index.shingles))]
    hit = hit[index.shingles[hit] == found[at < len(index.shingles)]]
    if not len(hit):
        return []
    owners = np.concatenate([index.items[index.first[h] : index.first[h + 1]] for h in hit])
    items, seen = np.unique(owners, return_counts=True)
    out = []
    for item in items[seen >= index.least[items]]:
        whole = index.sets[item]
        where = np.searchsorted(found, whole)
        where[where == len(found)] = 0
        shared = int((found[where] == whole).sum())
        if 100 * shared >= percent * len(whole):
            out.append((int(item), shared))
    return out


def _search(index, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_item", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index.value
        for batch in batches:
            rows = []
            for i, j in by_bytes(batch.column(1), CHUNK_BYTES):
                part = batch.slice(i, j - i)
                hashes, first = shingle_hashes(words_of(part.column(1)))
                if not len(items.shingles) or not len(hashes):
                    continue
                # most texts share nothing: one lookup for the whole piece
                at = np.searchsorted(items.shingles, hashes)
                at[at == len(items.shingles)] = 0
                touched = np.searchsorted(first, np.flatnonzero(items.shingles[at] == hashes), "right") - 1
                for k in np.unique(touched):
                    found = np.unique(hashes[first[k] : first[k + 1]])
                    doc = part.column(0)[int(k)].as_py()
                    rows += [(doc, items.ids[m], shared, len(items.sets[m])) for m, shared in matches(found, items, percent)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((), (), (), ()))], schema=schema)

    return run


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("item_id", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary())])
    for batch in batches:
        sets = list(shingle_sets(batch.column(1)))
        columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def contained_items(docs: DataFrame, benchmark: DataFrame, percent: int = 80, pass_shingles: int = PASS_SHINGLES) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) of every document that holds ``percent`` of an item's shingles.

    Shingles have five words, A-Z folded. Items without words match nothing; an
    item of fewer than five words only a document with the same words. Null ids
    stay null; repeated rows give repeated matches. Items go through memory in
    passes of about ``pass_shingles``, the documents are never shuffled.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    sets = items.mapInArrow(_item_sets, "item_id long, n long, hashes binary").where("n > 0")
    total = sets.agg(F.sum("n")).first()[0] or 0
    passes = -(-total // pass_shingles)
    out = spark.createDataFrame([], "doc_id long, item_id long, n_shared long, n_item long")
    for k in range(passes):
        mine = sets.where(F.pmod(F.xxhash64("hashes"), F.lit(passes)) == k).orderBy("item_id", "hashes")
        block = [(r["item_id"], np.frombuffer(r["hashes"], np.uint64)) for r in mine.toLocalIterator()]
        index = spark.sparkContext.broadcast(index_of(block, percent))
        found = texts.mapInArrow(_search(index, percent), "doc_id long, item_id long, n_shared long, n_item long")
        out = found if passes == 1 else out.union(found)
    return out


def without_test_items(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that hold no test item.

    Documents go by id, those with a null id by their text's hash.
    """
    named, unnamed = docs.where(F.col("doc_id").isNotNull()), docs.where(F.col("doc_id").isNull())
    hit = contained_items(named, benchmark, percent).select(F.col("doc_id").alias("__hit")).distinct()
    clean = named.join(hit, F.col("doc_id").cast("long") == F.col("__hit"), "left_anti")
    keyed = unnamed.withColumn("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))))
    bad = contained_items(keyed, benchmark, percent).select(F.col("doc_id").alias("__hit")).distinct()
    rest = unnamed.join(bad, F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__hit"), "left_anti")
    return clean.unionByName(rest)
