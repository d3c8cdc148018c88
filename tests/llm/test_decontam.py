import random

import numpy as np
import pytest

from viagrid.llm import decontam
from tests.llm.test_text import shingles


@pytest.mark.parametrize("passes", [1_000_000, 60])
def test_equals_brute_force(spark, docs_of, passes):
    rng = random.Random(3)
    item = [(k, " ".join(f"q{rng.randrange(900)}" for _ in range(rng.choice([3, 5, 6, 40, 200])))) for k in range(12)]
    docs = []
    for k in range(60):
        words = [f"d{rng.randrange(50)}" for _ in range(rng.choice([0, 10, 3000]))]
        passage = item[k % 12][1].split()
        cut = rng.choice([0, 1, len(passage) // 7, len(passage) // 4])
        docs.append((k, " ".join(words + [w.upper() for w in passage[cut:]] + words[:5])))
    docs += [(80, None), (81, ""), (82, item[0][1]), (None, item[3][1])]
    benchmark = spark.createDataFrame(item + [(50, None), (51, " ")], "item_id long, text string")
    found = decontam.contained_items(docs_of(docs), benchmark, 80, passes).collect()
    sets = {k: shingles(t) for k, t in item}
    want = [(d, k, len(s & shingles(t)), len(s)) for d, t in docs for k, s in sets.items() if 100 * len(s & shingles(t)) >= 80 * len(s)]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr) and len(want) > 10
    left = decontam.without_test_items(docs_of(docs), benchmark).collect()
    hit = {d for d, *_ in want}
    assert sorted(r.doc_id for r in left) == sorted(d for d, _ in docs if d not in hit)


def test_sketches_always_meet():
    for n in (1, 2, 3, 17, 400):
        shingle = np.sort(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
        assert len(decontam.sketch(shingle, 80)) > n // 5


def test_no_rows(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contained_items(docs_of([(1, "a b c")]), none).count() == 0
    assert decontam.without_test_items(docs_of([]), none).count() == 0


def test_equals_sql(same_as_sql):
    same_as_sql("op6_contained_items")
