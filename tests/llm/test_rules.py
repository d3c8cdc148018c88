import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from viagrid.llm import rules
from viagrid.llm.stats import COUNTS, SHAPES, text_stats

ODD = ["a b c a b c", "a a a a", "a a a", "one\none\n two\none\n\n \n two", "#$ %& é|<>*", "", None, "x" * 50_000 + " é", "A b\x0bc\x1cd\te f"]


def counts(text):
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.split()]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    chars = sum(len(w.decode()) for w in words)
    return (len(words), chars, sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def check(texts):
    found = text_stats(pa.array(texts, pa.string()))
    assert list(zip(*(found[c].tolist() for c in COUNTS))) == [counts(t) for t in texts]
    shapes = np.stack([found[s] for s in SHAPES])
    assert np.isfinite(shapes).all()


def test_odd_texts():
    check(ODD)
    check([None])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n#é", max_size=40)), min_size=1, max_size=8))
def test_any_texts(texts):
    check(texts)


def test_outliers_have_short_paths():
    rng = np.random.default_rng(2)
    usual = rng.normal(0, 1, (2560, len(SHAPES)))
    forest = rules.fit(usual, 50, 256)
    scores = forest.scores(np.vstack([usual[:500], np.full((5, len(SHAPES)), 9.0)]))
    assert scores[500:].min() > np.quantile(scores[:500], 0.99)
    assert (rules.fit(usual, 50, 256).scores(usual[:50]) == forest.scores(usual[:50])).all()


def path_by_recursion(forest, t, x, node=0):
    f = forest.feature[t][node]
    if f < 0:
        return forest.path[t][node]
    return path_by_recursion(forest, t, x, forest.child[t][node] + (x[f] >= forest.split[t][node]))


def test_scores_equal_a_walk_down_each_tree():
    x = np.random.default_rng(4).random((300, len(SHAPES)))
    forest = rules.fit(x, 20, 64)
    for row, score in zip(x[:20], forest.scores(x[:20])):
        mean = np.mean([path_by_recursion(forest, t, row) for t in range(20)])
        assert abs(score - 2 ** -(mean / forest.usual)) < 1e-12


def prose(k):
    rng = np.random.default_rng(k)
    return ". ".join(" ".join(f"w{rng.integers(900)}" for _ in range(12)) for _ in range(8))


def test_verdicts(spark, docs_of):
    rows = [(k, prose(k)) for k in range(200)] + [(300, "a b c"), (301, "a b c " * 60), (302, None), (303, ""), (None, prose(1)), (5, prose(5))]
    labels = spark.createDataFrame([(k, 1) for k in range(200)] + [(301, 0), (None, 1)], "doc_id long, quality int")
    found = rules.judged(docs_of(rows), labels, 20, 64).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert sum(not r.kept for r in found if r.doc_id is not None and r.doc_id < 200) == 0
    again = rules.judged(docs_of(rows[::-1]), labels, 20, 64).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    left = rules.passing(docs_of(rows), labels)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([*range(200), 5, None], key=repr)
    assert left.columns == docs_of(rows).columns


def test_no_rows_and_no_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.judged(docs_of([]), none).count() == 0
    assert rules.judged(docs_of([(1, prose(1))]), none).collect()[0].kept


def test_labelled_junk_is_rejected(spark, docs_of):
    junk = [(k, " ".join(f"{w}{mark}" for w, mark in zip(prose(k).split(), ["###", "%%%", "&&&", "$$$"] * 99))) for k in range(200, 240)]
    rows = [(k, prose(k)) for k in range(200)] + junk
    wrongly = range(200, 240, 10)  # a few labels are wrong, as in any labelled table
    labels = spark.createDataFrame([(k, int(k < 200 or k in wrongly)) for k, _ in rows], "doc_id long, quality int")
    found = {r.doc_id: r for r in rules.judged(docs_of(rows), labels, 20, 64).collect()}
    assert not any(found[k].base_failed for k in found)
    assert not any(found[k].kept for k in range(200, 240) if k not in wrongly)
    assert sum(found[k].kept for k in range(200)) >= 196


def test_thresholds(spark):
    def step(good, bad):
        every = [(k, s, q) for k, (s, q) in enumerate([(s, 1) for s in good] + [(s, 0) for s in bad])]
        scored = spark.createDataFrame([(k, s, False) for k, s, _ in every], "doc_id long, step long, base_failed boolean")
        return rules.threshold(scored, spark.createDataFrame([(k, q) for k, _, q in every] + [(0, None)], "doc_id long, quality int"))

    assert 800 <= step([800] * 50 + [1900], [1200] * 20 + [700]) < 1200
    assert step([800] * 50, [1200]) == 1000
    assert step([800] * 50, []) == 800
    assert step([], [1200]) == rules.STEPS


def test_all_trees_are_built_at_every_size():
    rng = np.random.default_rng(5)
    for n, own in ((1, 1), (2, 2), (10, 10), (199, 16), (200, 16), (1000, 62), (5_000, 256), (30_000, 256)):
        x = rng.normal(0, 1, (n, len(SHAPES)))
        forest = rules.fit(x, 100, 256)
        assert len(forest.feature) == 100 and forest.depth == max(1, int(np.ceil(np.log2(max(2, own)))))
        assert ((forest.feature >= 0).sum(axis=1) < own).all()
        if n > 2:
            assert len({tuple(row) for row in forest.split[:, :3]}) > 90  # each has rows of its own
    assert len(rules.fit(np.empty((0, len(SHAPES))), 100, 256).feature) == 0
