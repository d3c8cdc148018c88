import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from viagrid.llm import negatives

KIND = "vec_id long, label int, embedding array<float>, score string, x string, slot int, rank int"


def whole(vector):
    return [max(-negatives.MOST_UNITS, min(negatives.MOST_UNITS, int(np.floor(256 * float(np.float32(c)))))) for c in vector]


def brute_force(rows):
    """The contract, row by row; every repeated row is a candidate."""
    part = [(k, label, whole(v)) for k, label, v in rows if None not in (k, label, v) and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for a in sorted({(k, label, tuple(x)) for k, label, x in part if k % 100 == 0}):
        scored = sorted((-sum(p * q for p, q in zip(a[2], x)), k, label) for k, label, x in part)
        for s, p, _ in [r for r in scored if r[2] == a[1] and r[1] != a[0]][:5]:
            near = [r for r in scored if r[2] != a[1] and 30 * -s <= 100 * -r[0] <= 90 * -s][:10]
            out += [(a[0], p, rank, k, -s, -t) for rank, (t, k, _) in enumerate(near, 1)]
    return sorted(out)


@pytest.fixture
def mined(spark, values):
    def run(rows):
        frame = spark.createDataFrame([(*r, "s", "x", 1, 2) for r in rows], KIND)
        return values(negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0))

    return run


def test_packed_products_are_exact():
    rng = np.random.default_rng(1)
    for low, high, d, n in ((-200, 200, 64, 50), (0, 1, 3, 7), (-(1 << 23), 1 << 23, 96, 20), (-5, -1, 4, 1), (0, 0, 2, 3)):
        rows, anchors = rng.integers(low, high, (n, d), endpoint=True), rng.integers(low, high, (5, d), endpoint=True)
        bias = -int(anchors.min())
        packed = negatives.Packed(rows, int(anchors.max()) + bias)
        for a in anchors:
            assert packed.scores((a + bias).tolist(), bias).tolist() == (rows.astype(object) @ a.astype(object)).tolist()


def test_firsts_keep_ties_in_order(monkeypatch):
    monkeypatch.setattr(negatives, "SORTED_HITS", 7)
    draw = random.Random(2)
    rows = [(draw.randrange(3), draw.randrange(4), draw.randrange(50)) for _ in range(200)]
    firsts = negatives.Firsts(3, 4)
    for i in range(0, 200, 5):
        firsts.add(*(np.array(c) for c in zip(*rows[i : i + 5])))
    want = [r for g in range(3) for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:4]]
    assert list(zip(*(c.tolist() for c in firsts.settled()))) == want


def test_like_brute_force_with_ties_and_odd_rows(mined):
    draw = random.Random(4)
    vector = lambda: [draw.choice((-0.5, 0.25, 0.5, 1.0)) for _ in range(3)]  # noqa: E731  many ties
    rows = [(k, draw.randrange(3), vector()) for k in range(0, 1000, 10)]
    rows += [(rows[5][0], rows[5][1], rows[5][2]), (200, rows[20][1], rows[20][2])]  # repeated rows, one an anchor
    rows += [(1, None, [1.0] * 3), (2, 0, None), (3, 0, [1.0, None, 1.0]), (4, 0, [float("nan")] * 3), (5, 1, [float("inf")] * 3), (None, 1, [1.0] * 3), (6, 1, []), (7, 2, [1.0, 1.0]), (8, 2, [1e9] * 3)]
    found = mined(rows)
    assert found == sorted(map(tuple, brute_force(rows)), key=repr) and found


def test_hot_label_and_several_passes(mined, monkeypatch):
    monkeypatch.setattr(negatives, "PASS_NUMBERS", 40)
    monkeypatch.setattr(negatives, "PART_ROWS", 64)
    rng = np.random.default_rng(3)
    rows = [(k * 20, 1 if k % 3 else int(k % 5), rng.standard_normal(8).astype(np.float32).tolist()) for k in range(400)]
    assert mined(rows) == sorted(map(tuple, brute_force(rows)), key=repr)


def test_few_rows(mined):
    assert mined([]) == []
    assert mined([(100, 1, [1.0])]) == []
    assert mined([(100, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5])]) == [(100, 1, 1, 2, 65536, 32768)]
    assert mined([(100, 1, []), (1, 1, []), (2, 2, [])]) == [(100, 1, 1, 2, 0, 0)]


def test_query_equals_its_sql(same_as_sql):
    same_as_sql("op11_hard_negatives")
