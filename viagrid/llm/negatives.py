"""Hard-negative mining with Kronecker-packed inner products.

Components are whole numbers. A block of candidates is packed into one wide
integer per component, each candidate biased to be non-negative and given a
field wide enough for any score of the block. An anchor's component multiplies
that integer once, for all candidates together; the fields of the sum, less what
the biases added, are the exact scores. Anchors are taken in blocks that go to
the tasks, which hold the candidates of their partition; each task sends its
first few rows per anchor, and these are merged.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viagrid.llm.components import stored
from viagrid.session import work_folder

#: Units per 1 of a component, and the units that a larger one counts as.
UNIT, MOST_UNITS = 256, 1 << 23
#: Candidates in a partition at least, candidates packed together, components of the anchors of a pass, hits sorted at a time.
PART_ROWS, PACKED_ROWS, PASS_NUMBERS, SORTED_HITS = 1 << 14, 1 << 12, 1 << 20, 1 << 19


class Packed:
    """Candidates, a matrix of whole numbers, as one wide integer per component."""

    def __init__(self, rows: np.ndarray, most_factor: int):
        self.count, d = rows.shape
        self.bias = -int(rows.min(initial=0))
        raised = rows.astype(np.int64) + self.bias
        largest = max(1, d * max(1, int(raised.max(initial=0))) * max(1, most_factor))
        self.width = (largest.bit_length() + 7) // 8
        fields = np.ascontiguousarray(raised.T).astype("<u8").view(np.uint8).reshape(d, self.count, 8)[:, :, : self.width]
        self.wide = [int.from_bytes(row.tobytes(), "little") for row in fields]
        self.sums = raised.sum(axis=1)

    def scores(self, factors: list[int], bias: int) -> np.ndarray:
        """Inner products of every candidate with ``factors`` less ``bias``; factors are 0 to ``most_factor``."""
        total = sum(map(operator.mul, self.wide, factors))
        fields = np.zeros((self.count, 8), np.uint8)
        fields[:, : self.width] = np.frombuffer(total.to_bytes(self.width * self.count, "little"), np.uint8).reshape(self.count, self.width)
        return fields.view("<i8").ravel() - self.bias * (sum(factors) - bias * len(factors)) - bias * self.sums


def matrix_of(vectors: pa.ListArray, d: int) -> np.ndarray:
    """Vectors as rows of length ``d``, shorter ones followed by zeros."""
    lengths = np.asarray(vectors.value_lengths(), np.int64)
    out = np.zeros((len(vectors), d), np.int64)
    out[np.arange(d) < lengths[:, None]] = np.asarray(vectors.flatten())
    return out


class Firsts:
    """The first ``most`` (score, id) of each group, higher scores first, then smaller ids."""

    def __init__(self, groups: int, most: int):
        self.most = most
        self.least = np.full(groups, np.iinfo(np.int64).min)  # a lower score comes too late
        self.kept = tuple(np.empty(0, np.int64) for _ in range(3))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.hits = 0

    def add(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        self.waiting.append((groups, scores, ids))
        self.hits += len(groups)
        if self.hits >= SORTED_HITS:
            self.settled()

    def settled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Groups, scores and ids of what is first so far, by group."""
        groups, scores, ids = (np.concatenate(x) for x in zip(self.kept, *self.waiting))
        order = np.lexsort((ids, -scores, groups))
        groups, scores, ids = groups[order], scores[order], ids[order]
        first = np.searchsorted(groups, groups)
        near = np.arange(len(groups)) - first < self.most
        self.kept = groups[near], scores[near], ids[near]
        last = np.arange(len(groups)) - first == self.most - 1
        self.least[groups[last]] = scores[last]
        self.waiting, self.hits = [], 0
        return self.kept


class Anchors:
    """The anchors of a pass: ids, labels and their components, raised to be non-negative."""

    def __init__(self, rows: list, d: int):
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        whole = np.zeros((len(rows), d), np.int64)
        for k, r in enumerate(rows):
            whole[k, : len(r["x"])] = r["x"]
        self.bias = -int(whole.min(initial=0))
        self.factors = (whole + self.bias).tolist()
        self.most_factor = int(whole.max(initial=0)) + self.bias
        self.d = d


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and components of ``PACKED_ROWS`` candidates at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, PACKED_ROWS):
            part = batch.slice(i, PACKED_ROWS)
            yield np.asarray(part.column("vec_id")), np.asarray(part.column("label")), matrix_of(part.column("x"), d)


def _positives(anchors: Anchors, most: int):
    by_label = {label: np.flatnonzero(anchors.labels == label) for label in np.unique(anchors.labels)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = Firsts(len(anchors.ids), most)
        for ids, labels, rows in _blocks(batches, anchors.d):
            for label, own in by_label.items():
                at = np.flatnonzero(labels == label)
                if not len(at):
                    continue
                packed = Packed(rows[at], anchors.most_factor)
                for a in own:
                    scores = packed.scores(anchors.factors[a], anchors.bias)
                    hit = np.flatnonzero((scores >= firsts.least[a]) & (ids[at] != anchors.ids[a]))
                    firsts.add(np.full(len(hit), a), scores[hit], ids[at][hit])
        groups, scores, found = firsts.settled()
        yield pa.RecordBatch.from_arrays([pa.array(groups), pa.array(scores), pa.array(found)], names=["anchor", "score", "vec_id"])

    return run


def _negatives(anchors: Anchors, slots: np.ndarray, lows: np.ndarray, highs: np.ndarray, most: int):
    """``slots`` of an anchor begin at ``slots[anchor]``; each has the scores from ``lows`` to ``highs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = Firsts(len(lows), most)
        for ids, labels, rows in _blocks(batches, anchors.d):
            packed = Packed(rows, anchors.most_factor)
            for a in range(len(anchors.ids)):
                own = np.arange(slots[a], slots[a + 1])
                if not len(own):
                    continue
                scores = packed.scores(anchors.factors[a], anchors.bias)
                other = labels != anchors.labels[a]
                for slot in own:
                    at = np.flatnonzero((scores >= max(lows[slot], firsts.least[slot])) & (scores <= highs[slot]) & other)
                    if len(at) > 4 * most:
                        at = at[scores[at] >= np.partition(scores[at], -most)[-most]]
                    if len(at):
                        firsts.add(np.full(len(at), slot), scores[at], ids[at])
        groups, scores, found = firsts.settled()
        yield pa.RecordBatch.from_arrays([pa.array(groups), pa.array(scores), pa.array(found)], names=["slot", "score", "vec_id"])

    return run


def _first(rows: DataFrame, group: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group, numbered."""
    order = Window.partitionBy(group).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def candidates_of(rows: DataFrame) -> DataFrame:
    """vec_id, label and x, the vector in whole units, of the rows with an id, a label and a finite vector."""
    finite = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    most = F.lit(float(MOST_UNITS))
    x = F.transform("embedding", lambda e: F.floor(F.least(F.greatest(e.cast("double") * UNIT, -most), most)).cast("int"))
    kept = rows.where(F.coalesce(finite, F.lit(False)) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90) -> DataFrame:
    """Hard negatives of every anchor and positive: see ``MINED``.

    ``rows`` has vec_id, label and embedding; ``is_anchor`` marks anchors by
    vec_id. An anchor's positives are the first rows of its label with another
    vec_id; negatives are the first rows of other labels whose score is between
    the given percentages of the positive's (none where that is negative). Rows
    come first by higher score, then by smaller vec_id.

    Rows without vec_id or label, or whose vector is null or holds a null or an
    entry that is not finite, take no part; an empty vector scores 0. Vectors of
    unequal length are multiplied over the components both have; an entry of
    over 32,768 counts as that. A repeated row is a candidate each time, an
    anchor once. Other columns are ignored. Each pass takes as many anchors as
    have ``PASS_NUMBERS`` components, all passes all candidates.
    """
    spark = rows.sparkSession
    whole = candidates_of(rows)
    n, d = whole.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    parts = max(spark.sparkContext.defaultParallelism, -(-n // PART_ROWS))
    candidates = stored(spark, whole.repartition(parts), "candidates")
    anchors = stored(spark, candidates.where(is_anchor).distinct(), "anchors")
    passes = -(-anchors.count() * max(1, d) // PASS_NUMBERS)
    path = work_folder(spark, "negatives")
    spark.createDataFrame([], MINED).write.parquet(path)
    for k in range(passes):
        held = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(passes)) == k).collect()
        if held:
            _mined(candidates, Anchors(held, d), positives, negatives, least_percent, most_percent).write.mode("append").parquet(path)
    return spark.read.schema(MINED).parquet(path)


def _mined(candidates: DataFrame, anchors: Anchors, positives: int, negatives: int, least_percent: int, most_percent: int) -> DataFrame:
    """The result for the anchors of a pass."""
    spark = candidates.sparkSession
    near = _first(candidates.mapInArrow(_positives(anchors, positives), "anchor long, score long, vec_id long"), "anchor", positives)
    found = sorted((r["anchor"], r["rank"], r["vec_id"], r["score"]) for r in near.collect())
    slots = np.searchsorted(np.array([r[0] for r in found], np.int64), np.arange(len(anchors.ids) + 1))
    lows = np.array([-(-least_percent * r[3] // 100) for r in found], np.int64)
    highs = np.array([most_percent * r[3] // 100 for r in found], np.int64)
    hits = _first(candidates.mapInArrow(_negatives(anchors, slots, lows, highs, negatives), "slot long, score long, vec_id long"), "slot", negatives)
    of_slot = [(slot, int(anchors.ids[r[0]]), r[2], r[3]) for slot, r in enumerate(found)]
    named = spark.createDataFrame(of_slot, "slot long, anchor_id long, positive_id long, positive_score long")
    return hits.join(named, "slot").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
