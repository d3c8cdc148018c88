import random

import pytest

from viagrid.llm import neardup
from viagrid.llm.components import components
from tests.llm.test_text import shingles


def brute(rows, percent):
    sets = {}
    for k, t in rows:
        sets.setdefault(k, set()).update(shingles(t))
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {k: (len(sets[k]), top(k)) for k in sets}


def family(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(400)}" for _ in range(90)]
    rows = []
    for k in range(n):
        own = list(words)
        for _ in range(rng.randrange(6)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(9)}"
        rows.append((k * 7 + seed, " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_families_equal_brute_force(docs_of, block):
    rows = family(1) + family(2, 30) + [(900, "a b"), (901, "A B"), (902, "a b c"), (903, ""), (904, None), (905, "a\tb\n")]
    found = neardup.near_duplicates(docs_of(rows), 85, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_nulls_repeats_and_no_rows(docs_of):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a b c"), (3, None)]
    found = neardup.near_duplicates(docs_of(rows), 80).collect()
    assert sorted([(r.doc_id, r.component_id, r.kept) for r in found], key=repr) == sorted(
        [(1, 1, True), (1, 1, True), (None, None, True), (2, 1, False), (3, 3, True)], key=repr
    )
    assert sorted((r.doc_id or 0) for r in neardup.without_near_duplicates(docs_of(rows)).collect()) == [0, 1, 3]
    assert neardup.near_duplicates(docs_of([]), 80).count() == 0
    assert neardup.without_near_duplicates(docs_of([])).columns == docs_of([]).columns


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(k, k + 1) for k in range(100, 130)] + [(5, k) for k in range(40, 60)] + [(7, 7), (None, 3), (60, 59), (60, 59)]
    found = dict(map(tuple, components(spark, spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {k: 100 for k in range(100, 131)} | {k: 5 for k in [5, *range(40, 61)]}


def test_equals_sql(same_as_sql):
    same_as_sql("op10_near_duplicates")


def test_a_family_of_near_copies_is_not_compared_all_against_all(docs_of, monkeypatch):
    kept = {}

    def watched(spark, df, label):
        kept[label] = stored(spark, df, label)
        return kept[label]

    stored = neardup.stored
    monkeypatch.setattr(neardup, "stored", watched)
    draw = random.Random(9)
    words = [f"w{draw.randrange(4000)}" for _ in range(120)]
    rows = [(0, " ".join(words))]
    for k in range(1, 600):
        own = list(words)
        own[draw.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(own)))
    found = neardup.near_duplicates(docs_of(rows), 80, block=64).collect()
    sets = {k: len(shingles(t)) for k, t in rows}
    classes = kept["classes"].count()
    assert kept["near-first"].count() + kept["promising"].count() < 3 * classes
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {k: (sets[k], 0) for k in sets}
