"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The distinct vectors X, centred, are never copied: each step is two passes over
them, one for the product with a right vector v, one for the product of its
orthogonalised image u with the transpose. Every left vector is u = Xp for some p
of the vectors' dimension, so the driver holds the short vectors v, p and X'u only,
and a lost task repeats one pass over its own rows. Both sides are orthogonalised
against all before them. The singular values of the small bidiagonal matrix are
the deviations, its right vectors give the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viagrid.llm.components import stored

#: Units per 1 and offset of the whole numbers that stand for entries; larger entries count as this many units.
UNIT, OFFSET, MOST_UNITS = 64, 1_000_000, 1 << 53
#: A residual, and a deviation, up to this share of the largest deviation counts as none.
CONVERGED, NONE = 1e-14, 1e-11

#: Y'Yq and the squared length of Yq, for the centred rows Y.
Product = Callable[[np.ndarray], tuple[np.ndarray, float]]


@dataclass
class Centre:
    """Count and sums of the distinct vectors; ``wide`` if n times an entry may pass 62 bits."""

    n: int
    sums: list[int]
    wide: bool

    def whole(self, vectors: pa.ListArray) -> np.ndarray:
        """n times each vector less the sums, in whole numbers."""
        x = np.asarray(vectors.flatten()).reshape(-1, len(self.sums))
        if self.wide:
            return x.astype(object) * self.n - np.array(self.sums, dtype=object)
        return x * self.n - np.array(self.sums, dtype=np.int64)

    def rows(self, vectors: pa.ListArray) -> np.ndarray:
        """The centred vectors."""
        return self.whole(vectors).astype(np.float64) / self.n


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x, the vector in whole units, of the rows whose vector is not null, not empty and finite throughout."""
    finite = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    most = F.lit(float(MOST_UNITS))
    x = F.transform(vector, lambda e: F.floor(F.least(F.greatest(e.cast("double") * UNIT, -most), most)).cast("long") + OFFSET)
    return rows.where(F.coalesce(finite & (F.size(vector) > 0), F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: the count (at -1) and the sum of each dimension, with its largest size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
        high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        sums = [Decimal(batch.num_rows), *(Decimal((int(h) << 32) + int(l)) for h, l in zip(high, low))]
        most = np.concatenate(([0], np.abs(x).max(axis=0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(most) - 1), pa.int32()), pa.array(sums, pa.decimal128(38, 0)), pa.array(most)], names=["at", "value", "most"])


def centre_of(fit: DataFrame) -> Centre:
    """Count and exact sums of the rows of ``fit``; as many numbers as a vector has reach the driver."""
    found = fit.mapInArrow(_sums, "at int, value decimal(38,0), most long").groupBy("at").agg(F.sum("value").alias("value"), F.max("most").alias("most")).orderBy("at").collect()
    n = int(found[0]["value"])
    return Centre(n, [int(r["value"]) for r in found[1:]], n * max(r["most"] for r in found) >= 1 << 61)


def _summed(fit: DataFrame, made: Callable[[np.ndarray], np.ndarray], centre: Centre) -> np.ndarray:
    """The sum over the centred rows of ``fit`` of what ``made`` gives for a batch of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            total = total + made(centre.rows(batch.column("x")))
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["at", "value"])

    rows = fit.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()
    return np.array([r["value"] for r in rows])


def product_with(fit: DataFrame, centre: Centre) -> Product:
    """The product as one pass over ``fit``."""

    def product(q: np.ndarray) -> tuple[np.ndarray, float]:
        def made(y: np.ndarray) -> np.ndarray:
            image = y @ q
            return np.append(image @ y, image @ image)

        total = _summed(fit, made, centre)
        return total[:-1], float(total[-1])

    return product


def _without(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What is left of ``x`` outside an orthonormal basis."""
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    return x


def bidiagonalised(product: Product, start: np.ndarray, locked: np.ndarray, wanted: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Deviations (times the root of n) and components in the space that ``start`` opens outside ``locked``.

    Stops when that space is exhausted (all of its values are returned) or, in
    its first half, when the ``wanted`` largest have converged (those are returned).
    """
    d = len(start)
    v = _without(start, locked)
    vs, ps, images = np.empty((d, 0)), np.empty((d, 0)), np.empty((d, 0))  # v; p with u = Yp; Y'u
    alphas, betas = [], []
    while True:
        v = v / np.linalg.norm(v)
        p = v
        for _ in range(2):
            scattered, square = product(p)
            shares = ps.T @ scattered
            p = p - ps @ shares
        alpha = float(np.sqrt(max(0.0, square - shares @ shares)))
        if alpha <= NONE * max(scale, max(alphas, default=0.0)):
            break
        vs = np.column_stack((vs, v))
        ps = np.column_stack((ps, p / alpha))
        images = np.column_stack((images, (scattered - images @ shares) / alpha))
        alphas.append(alpha)
        rest = _without(images[:, -1] - alpha * v, np.column_stack((locked, vs)))
        beta = float(np.linalg.norm(rest))
        left, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        room = d - locked.shape[1]
        if len(values) == room or beta <= CONVERGED * max(scale, values[0]):
            return values, vs @ right.T
        if wanted <= len(values) <= room // 2 and (beta * np.abs(left[-1, :wanted]) <= CONVERGED * max(scale, values[0])).all():
            return values[:wanted], vs @ right.T[:, :wanted]
        betas.append(beta)
        v = rest
    if not alphas:
        return np.empty(0), np.empty((d, 0))
    _, values, right = np.linalg.svd(np.column_stack((np.diag(alphas) + np.diag(betas[:-1], 1), np.append(np.zeros(len(alphas) - 1), betas[-1]))))
    return values, np.column_stack((vs, v)) @ right.T[:, : len(values)]


def principal(product: Product, d: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest singular values of the centred rows and their right vectors, fewer if the rank is less.

    One start finds each value once. Another start outside the vectors found
    looks for further ones, until it finds none that counts, so equal values are
    found as often as they occur.
    """
    draw = np.random.default_rng(13)
    values, vectors = np.empty(0), np.empty((d, 0))
    while len(values) < d:
        scale = values[0] if len(values) else 0.0
        more, along = bidiagonalised(product, draw.standard_normal(d), vectors, wanted, scale)
        if not len(more):
            break
        least = values[wanted - 1] if len(values) >= wanted else 0.0
        order = np.argsort(-np.concatenate((values, more)), kind="stable")
        values, vectors = np.concatenate((values, more))[order], np.column_stack((vectors, along))[:, order]
        if more[0] <= least:
            break
    kept = values[:wanted] > NONE * (values[0] if len(values) else 0.0)
    return values[:wanted][kept], vectors[:, :wanted][:, kept]


@dataclass
class Whitening:
    """Centre, components by falling variance, their variances, shares of the whole variance, and the largest error of the whitened covariance."""

    centre: Centre
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


def fitted(fit: DataFrame, wanted: int = 16) -> Whitening:
    """The whitening of the rows ``x`` of ``fit``, which are taken as they are; ``fit`` is read many times and should be stored."""
    centre = centre_of(fit)
    d = len(centre.sums)
    values, components = principal(product_with(fit, centre), d, wanted)
    variances = values**2 / centre.n
    whole = float(_summed(fit, lambda y: np.array([np.einsum("ij,ij->", y, y)]), centre)[0]) / centre.n
    error = 0.0
    if len(values):
        scaled = components / np.sqrt(variances)

        def products(y: np.ndarray) -> np.ndarray:
            z = y @ scaled
            return (z.T @ z).ravel()

        covariance = _summed(fit, products, centre).reshape(len(values), -1) / centre.n
        error = float(np.abs(covariance - np.eye(len(values))).max())
    return Whitening(centre, components, variances, variances / whole if whole else variances, error)


def _deviations(whole: np.ndarray) -> pa.Array:
    """Sums of squares; null where one does not fit a long."""
    about = (whole.astype(np.float64) ** 2).sum(axis=1)
    if not len(about) or (whole.dtype != object and about.max() < 2.0**62):
        return pa.array((whole.astype(np.int64) ** 2).sum(axis=1), pa.int64())
    exact = [sum(int(e) ** 2 for e in row) for row in whole]
    return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())


def _whitened(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        scaled = model.components / np.sqrt(model.variances)
        for batch in batches:
            whole = model.centre.whole(batch.column("x"))
            rows = np.repeat(np.arange(batch.num_rows), k)
            columns = [
                batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), batch.num_rows), pa.int32()),
                pa.array(np.full(len(rows), model.centre.n)), _deviations(whole).take(pa.array(rows)),
                pa.array((whole.astype(np.float64) / model.centre.n @ scaled).ravel()), pa.array(np.tile(model.explained, batch.num_rows)),
                pa.array(np.full(len(rows), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=WHITENED_NAMES)

    return run


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
WHITENED_NAMES = [column.split()[0] for column in WHITENED.split(", ")]


def whitened(rows: DataFrame, wanted: int = 16) -> DataFrame:
    """One row per embedding and component: see ``WHITENED``.

    Fits on the distinct vectors, so copies weigh nothing, and applies to all
    rows, repeated ones and null ids included; other columns are ignored. Rows
    whose vector is null, empty, or holds a null or an entry that is not finite
    take no part, nor do vectors of another length than the most frequent (the
    longer one of equals). There are as many components as the vectors have
    directions with variance, so none for an empty table or for one vector.
    """
    spark = rows.sparkSession
    points = stored(spark, whole_vectors(rows).withColumn("d", F.size("x")), "vectors")
    distinct = stored(spark, points.select("d", "x").distinct(), "distinct")
    usual = distinct.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if usual is None:
        return spark.createDataFrame([], WHITENED)
    model = fitted(distinct.where(F.col("d") == usual["d"]).select("x"), wanted)
    return points.where(F.col("d") == usual["d"]).select("vec_id", "x").mapInArrow(_whitened(model), WHITENED)
