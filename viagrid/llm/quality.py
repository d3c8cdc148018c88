"""Quality classifier: regularised quadratic discriminant analysis on the shape of texts.

Each class is a Gaussian with a covariance shrunk towards the pooled one and
towards its diagonal. Moments are summed over all learning rows in whole
numbers, so neither partitions nor retries change the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viagrid.llm.components import stored
from viagrid.llm.stats import SHAPES, with_stats

#: Shrinkage towards the pooled covariance, then towards its diagonal.
TO_POOLED, TO_DIAGONAL = 0.2, 0.1
#: Units per 1 in which moments are summed, and the bound on a transformed value.
UNIT, BOUND = 1 << 12, 32.0
#: Smallest variance of a value, in squared units of the transformed statistics.
LEAST_VARIANCE = 1e-4


def transformed(shapes: np.ndarray) -> np.ndarray:
    """Shares through a log-odds-like stretch, logs as they are; in whole units."""
    x = shapes.copy()
    share = [i for i, name in enumerate(SHAPES) if not name.startswith("log_")]
    x[:, share] = np.log(x[:, share] + 0.01) + 4.6
    return np.rint(np.clip(x, -BOUND, BOUND) * UNIT).astype(np.int64)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log weights of classes 0 and 1."""

    means: list[np.ndarray]
    inverses: list[np.ndarray]
    offsets: list[float]

    def scores(self, shapes: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        x = transformed(shapes) / UNIT
        logs = []
        for mean, inverse, offset in zip(self.means, self.inverses, self.offsets):
            z = (x - mean) @ inverse.T
            logs.append(offset - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fitted(moments: dict[int, tuple[int, np.ndarray, np.ndarray]], to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL) -> Discriminant | float:
    """A discriminant from count, sums and sums of products of classes 0 and 1; a constant score if one has under two rows."""
    counts = [moments[k][0] if k in moments else 0 for k in (0, 1)]
    if min(counts) < 2:
        return (counts[1] + 1) / (sum(counts) + 2)
    means, scatters = [], []
    for k in (0, 1):
        n, first, second = moments[k]
        mean = first / n / UNIT
        means.append(mean)
        scatters.append(second / UNIT / UNIT - n * np.outer(mean, mean))
    pooled = sum(scatters) / (sum(counts) - 2)
    inverses, offsets = [], []
    for n, scatter in zip(counts, scatters):
        cov = (1 - to_pooled) * scatter / (n - 1) + to_pooled * pooled
        cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(cov)) + LEAST_VARIANCE * np.eye(len(cov))
        factor = np.linalg.cholesky(cov)
        inverses.append(np.linalg.inv(factor))
        offsets.append(float(np.log(n / sum(counts)) - np.log(np.diag(factor)).sum()))
    return Discriminant(means, inverses, offsets)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and class: count, sums and sums of products, as whole numbers."""
    d = len(SHAPES)
    upper = np.triu_indices(d)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = transformed(np.asarray(batch.column("shape").flatten()).reshape(-1, d))
        y = np.asarray(batch.column("quality"))
        for k in np.unique(y):
            own = x[y == k]
            values = np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own)[upper]))
            n = len(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k), pa.int32()), pa.array(np.arange(n), pa.int32()), pa.array(values, pa.int64())], names=["quality", "at", "value"])


def learned(stats: DataFrame, labels: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Moments of the rows of ``stats`` that ``labels`` marks 0 or 1; a few hundred numbers reach the driver."""
    marked = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    rows = stats.select("doc_id", "shape").join(marked, "doc_id").select("quality", "shape")
    sums = rows.mapInArrow(_moments, "quality int, at int, value long").groupBy("quality", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    d, upper = len(SHAPES), np.triu_indices(len(SHAPES))
    out = {}
    for k in {r["quality"] for r in sums}:
        flat = np.array([float(v) for _, v in sorted((r["at"], r["value"]) for r in sums if r["quality"] == k)])
        second = np.zeros((d, d))
        second[upper] = flat[1 + d :]
        out[k] = (int(flat[0]), flat[1 : 1 + d], second + second.T - np.diag(np.diag(second)))
    return out


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("shape").flatten()).reshape(-1, len(SHAPES))
            found = model.value
            score = np.full(len(x), found) if isinstance(found, float) else found.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """True for the third of ids that is never learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Learns from the labelled rows that are not held out, all of them; an id
    labelled twice counts with its higher label, labels other than 0 and 1 and
    null ids not at all. A null text is an empty one; repeated rows score alike.
    With fewer than two rows of a class the score is the smoothed share of class 1.
    """
    spark = docs.sparkSession
    stats = stored(spark, with_stats(docs).select("doc_id", "shape"), "shapes")
    model = fitted(learned(stats.where(~held_out(F.col("doc_id"))), labels))
    rows = stats.mapInArrow(_scored(spark.sparkContext.broadcast(model)), "doc_id long, score double")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
