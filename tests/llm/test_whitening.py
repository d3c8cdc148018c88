import numpy as np
import pytest

from tests.llm.conftest import SMALL
from viagrid.llm import whitening
from viagrid.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int, x string, d int, at string, component int"


@pytest.fixture
def vectors_of(spark):
    def make(rows):
        return spark.createDataFrame([(k, v, 0, "x", 1, "a", 2) for k, v in rows], KIND)

    return make


def whole(vector):
    return [int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in vector]


def textbook(rows, wanted=16):
    """vec_id, component to deviation, whitened (sign free) and explained, by an eigendecomposition."""
    kept = [(k, whole(v)) for k, v in rows]
    fit = np.array(sorted(set(map(tuple, (x for _, x in kept)))), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(float) / n
    cov = centred.T @ centred / n
    e, vectors = np.linalg.eigh(cov)
    order = np.argsort(-e)[:wanted]
    out = []
    for k, x in kept:
        exact = [n * a - s for a, s in zip(x, sums)]
        for c, i in enumerate(order, 1):
            if e[i] > 1e-9 * e.max():
                out.append((k, c, n, sum(a * a for a in exact), abs(float(np.dot(np.array(exact, float) / n, vectors[:, i]) / np.sqrt(e[i]))), e[i] / np.trace(cov)))
    return sorted(out)


def same(found, want):
    found = sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained, r.identity_error) for r in found)
    assert [r[:4] for r in found] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in found], [r[4] for r in want], atol=1e-9) and np.allclose([r[5] for r in found], [r[5] for r in want])
    assert all(r[6] < 1e-9 for r in found)


@pytest.mark.parametrize("n, d", [(40, 5), (300, 24), (12, 30), (400, 80)])
def test_as_an_eigendecomposition(vectors_of, n, d):
    rng = np.random.default_rng(n)
    rows = [(k, (rng.standard_normal(d) * np.linspace(1, 6, d)).astype(np.float32).tolist()) for k in range(n)]
    rows += [(n + k, rows[3][1]) for k in range(20)]  # copies weigh nothing
    same(whitening.whitened(vectors_of(rows)).collect(), textbook(rows))


def test_decaying_values_stop_early():
    rng = np.random.default_rng(2)
    y = rng.standard_normal((500, 200)) * 2.0 ** -np.minimum(np.arange(200), 40)
    y -= y.mean(axis=0)
    calls = []

    def product(q):
        calls.append(1)
        image = y @ q
        return y.T @ image, float(image @ image)

    values, vectors = whitening.principal(product, 200, 4)
    _, s, right = np.linalg.svd(y)
    assert np.allclose(values, s[:4], rtol=1e-12) and len(calls) < 200
    assert np.allclose(np.abs(np.sum(vectors * right[:4].T, axis=0)), 1, atol=1e-12)


def test_equal_values_are_found_as_often_as_they_occur():
    for diagonal, wanted in (([3, 3, 3, 2, 2, 1, 1, 0, 0], 5), ([5.0] * 12, 3), ([4, 1e-13], 2), ([0, 0, 0], 2)):
        y = np.diag(np.array(diagonal, float))
        values, vectors = whitening.principal(lambda q: (y.T @ (y @ q), float((y @ q) @ (y @ q))), len(diagonal), wanted)
        assert np.allclose(values, [x for x in diagonal if x > 1e-9][:wanted])
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)


def test_rows_that_take_no_part(vectors_of):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, -1.0]), (3, [0.5, 0.25])]
    odd = [(4, None), (5, []), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 2.0, 3.0])]
    same(whitening.whitened(vectors_of(rows + odd)).collect(), textbook(rows))
    null_id = whitening.whitened(vectors_of(rows + [(None, [0.5, 0.25])])).where("vec_id is null").collect()
    assert len(null_id) == 2


def test_no_variance_no_components(vectors_of):
    assert whitening.whitened(vectors_of([])).count() == 0
    assert whitening.whitened(vectors_of([(1, None)])).count() == 0
    assert whitening.whitened(vectors_of([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_large_entries(vectors_of):
    rows = [(k, [float(np.float32(s * 1e13)), float(k)]) for k, s in enumerate((1, -1, 0.5))]
    found = whitening.whitened(vectors_of(rows)).collect()
    want = {(r[0], r[1]): r for r in textbook(rows)}
    assert {r.deviation for r in found} == {None}  # beyond a long
    assert np.allclose([abs(r.whitened) for r in found if r.component == 1], [want[r.vec_id, 1][4] for r in found if r.component == 1])
    clipped = whitening.whitened(vectors_of([(1, [1e30]), (2, [2e30]), (3, [-1.0])])).collect()
    assert len(clipped) == 3 and clipped[0].n == 2


def test_query_equals_the_textbook(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    same(QUERIES["op13_whitened_embeddings"](spark, SMALL).collect(), textbook(rows))
