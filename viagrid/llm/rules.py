"""Quality rules: base rules on counts, and an isolation forest on the shape of texts.

Each tree isolates a small hash-drawn sample by random splits; a document that
ends in few splits is an anomaly. Which anomaly is too much is calibrated on all
labelled rows, good and bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viagrid.llm.components import stored
from viagrid.llm.stats import COUNTS, SHAPES, with_stats

#: Size of the forest: rows in a tree's sample and trees; together the bound on what the fit reads.
TREE_ROWS, TREES = 256, 100
#: Part of a small sample that a tree has, and its least number of rows.
TREE_SHARE, LEAST_ROWS = 16, 16
#: Share of good labelled documents that the forest may reject where no bad ones are labelled.
GOOD_LOSS = 0.002
#: Steps in which scores are compared with the threshold.
STEPS = 2000


@dataclass
class Forest:
    """Trees as parallel arrays, a row per tree: feature (-1: leaf), split value, left child (right is next), path length at leaves."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    depth: int
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus mean path length over the usual one: near 1 is an anomaly."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = self.feature[t][at]
                step = self.child[t][at] + (x[rows, np.maximum(f, 0)] >= self.split[t][at])
                at = np.where(f < 0, at, step)
            total += self.path[t][at]
        return 2.0 ** -(total / max(1, len(self.feature)) / self.usual)


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grown(sample: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[list, list, list, list]:
    feature, split, child, path = [-1], [0.0], [0], [0.0]
    todo = [(0, sample, 0)]
    while todo:
        node, rows, level = todo.pop()
        spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else np.empty(0, np.int64)
        if level == depth or not len(spread):
            path[node] = level + expected_path(len(rows))
            continue
        f = int(rng.choice(spread))
        value = rng.uniform(rows[:, f].min(), rows[:, f].max())
        if value <= rows[:, f].min():
            value = rows[:, f].max()
        feature[node], split[node], child[node] = f, value, len(feature)
        for side in (rows[rows[:, f] < value], rows[rows[:, f] >= value]):
            todo.append((len(feature), side, level + 1))
            feature.append(-1)
            split.append(0.0)
            child.append(0)
            path.append(0.0)
    return feature, split, child, path


def fit(sample: np.ndarray, trees: int, tree_rows: int, seed: int = 7) -> Forest:
    """A forest of ``trees`` trees, each on rows of its own drawn from the whole sample.

    A tree has ``tree_rows`` rows, of a small sample one in ``TREE_SHARE`` (at
    least ``LEAST_ROWS``): trees that see most rows take a group of like
    anomalies for usual.
    """
    rng = np.random.default_rng(seed)
    own = min(tree_rows, len(sample), max(LEAST_ROWS, len(sample) // TREE_SHARE))
    depth = max(1, int(np.ceil(np.log2(max(2, own)))))
    built = [grown(sample[rng.permutation(len(sample))[:own]], depth, rng) for _ in range(trees)] if own else []
    most = max((len(b[0]) for b in built), default=1)
    filled = [np.array([b[k] + [z] * (most - len(b[k])) for b in built]) for k, z in enumerate((-1, 0.0, 0, 0.0))]
    usual = expected_path(max(2, own))
    return Forest(filled[0].astype(int), filled[1], filled[2].astype(int), filled[3], depth, usual)


def fitted_forest(stats: DataFrame, trees: int = TREES, tree_rows: int = TREE_ROWS) -> Forest:
    """A forest on ``trees * tree_rows`` documents with words, the first by a hash of id and shape.

    Only hashes low enough for about twice that number are looked at, so what the
    tasks send does not grow with the table.
    """
    marked = stats.where("n_words > 0").select(F.xxhash64("doc_id", "shape").alias("mark"), "doc_id", "shape")
    share = 2 * trees * tree_rows / max(1, marked.count())
    if share < 1:
        marked = marked.where(F.col("mark") < int((share - 0.5) * 2**64))
    drawn = marked.orderBy("mark", "doc_id").limit(trees * tree_rows)
    rows = [r["shape"] for r in drawn.collect()]
    return fit(np.array(rows).reshape(-1, len(SHAPES)), trees, tree_rows)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def threshold(scored: DataFrame, labels: DataFrame, loss: float = GOOD_LOSS) -> int:
    """The step with the fewest labelled rows on its wrong side (good above it, bad not), the middle one of equals.

    Where no bad row passes the base rules, the least step at which at most ``loss``
    of the good rows are above it; every step passes if no row is good.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = scored.where("not base_failed").join(known.distinct(), "doc_id").groupBy("step", "quality").count().collect()
    at = np.zeros((2, STEPS + 1), dtype=np.int64)
    for r in rows:
        at[r["quality"], r["step"]] += r["count"]
    bad, good = np.cumsum(at, axis=1)
    above = good[-1] - good
    if not good[-1]:
        return STEPS
    if not bad[-1]:
        return int(np.argmax(above <= int(loss * good[-1])))
    wrong = bad + above
    least = np.flatnonzero(wrong == wrong.min())
    return int(least[len(least) // 2])


def _scored(forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("shape").flatten()).reshape(-1, len(SHAPES))
            step = np.rint(forest.value.scores(x) * STEPS).astype(np.int64)
            kept = [batch.column(c) for c in ("doc_id", *COUNTS, "base_failed")]
            names = ["doc_id", *COUNTS, "base_failed", "step"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(step)], names=names)

    return run


def judged(docs: DataFrame, labels: DataFrame, trees: int = TREES, tree_rows: int = TREE_ROWS, loss: float = GOOD_LOSS) -> DataFrame:
    """doc_id, the counts, base_failed, anomaly (0 to 1) and kept of every row of ``docs``.

    ``labels`` has doc_id and quality (1: good, 0: bad); others calibrate nothing, and
    an id labelled both ways counts on both sides. A null or empty text has no words and fails the base rules. Repeated rows and null
    ids are judged like any other; without good labels the forest rejects none.
    """
    spark = docs.sparkSession
    stats = stored(spark, with_stats(docs), "stats")
    forest = spark.sparkContext.broadcast(fitted_forest(stats, trees, tree_rows))
    kind = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, step long"
    ready = stats.withColumn("base_failed", base_failed())
    scored = stored(spark, ready.mapInArrow(_scored(forest), kind), "scored")
    most = threshold(scored, labels, loss)
    anomaly, kept = (F.col("step") / STEPS).alias("anomaly"), (~F.col("base_failed") & (F.col("step") <= most)).alias("kept")
    return scored.select("doc_id", *COUNTS, "base_failed", anomaly, kept)


def passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep.

    The verdict is found by id, by the text's hash where the id is null; rows that
    share an id go together if any of them is rejected.
    """
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit("")))))
    texts = keyed.select(F.col("__key").alias("doc_id"), "text")
    rejected = judged(texts, labels).where("not kept").select(F.col("doc_id").alias("__key")).distinct()
    return keyed.join(rejected, "__key", "left_anti").select(*docs.columns)
