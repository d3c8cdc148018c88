import zlib

import numpy as np
import pytest

from viagrid.llm import quality
from viagrid.llm.stats import SHAPES
from viagrid.llm.queries import QUERIES
from tests.llm.conftest import SMALL


def test_moments_make_the_textbook_model():
    rng = np.random.default_rng(1)
    x = rng.random((400, len(SHAPES)))
    y = (x[:, 0] > 0.5).astype(int)
    t = quality.transformed(x)
    moments = {k: (int((y == k).sum()), t[y == k].sum(axis=0), t[y == k].T @ t[y == k]) for k in (0, 1)}
    model = quality.fitted(moments, 0.0, 0.0)
    u = t / quality.UNIT
    logs = []
    for k in (0, 1):
        own = u[y == k]
        cov = np.cov(own.T) + quality.LEAST_VARIANCE * np.eye(len(SHAPES))
        d = u - own.mean(axis=0)
        logs.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-8)


def test_one_class_gives_a_constant():
    assert quality.fitted({1: (8, np.zeros(1), np.zeros((1, 1)))}) == 0.9
    assert quality.fitted({}) == 0.5


def test_held_out_rows_are_not_learned_from(spark, docs_of):
    rows = [(k, ("the cat sat on a mat " if k % 2 else "# $ % & ") * (k % 7 + 3)) for k in range(60)] + [(90, ""), (91, None), (None, "x y")]
    labels = [(k, k % 2) for k in range(60)]
    kind = "doc_id long, quality int"
    docs = docs_of(rows)
    one = quality.scored(docs, spark.createDataFrame(labels + [(None, 1), (3, 7)], kind)).collect()
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 3 == 1 else q) for k, q in labels]
    two = quality.scored(docs, spark.createDataFrame(flipped, kind)).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, two), key=repr)
    for r in one:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    assert all(r.predicted == r.doc_id % 2 for r in one if r.doc_id is not None and r.doc_id < 60)


def test_no_rows(spark, docs_of):
    assert quality.scored(docs_of([]), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    good = truth == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, folder):
    found = QUERIES["op2_quality_discriminant"](spark, folder).where("held_out")
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert auc(np.array([r.score for r in rows]), np.array([r.quality for r in rows])) > 0.9
