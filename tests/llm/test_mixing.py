import random

from viagrid.llm import mixing


def filled(sizes, share=1.5, most=2.0):
    """Targets by sharing out again and again what is over."""
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sizes)}
    target, left, free = {}, share * sum(sizes.values()), set(sizes)
    while free:
        over = {s for s in free if left * weight[s] / sum(weight[f] for f in free) > most * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}


def rows_of(seed, counts):
    rng = random.Random(seed)
    return [(k * 100_000 + i, "w " * rng.choice([0, 1, 5, 40, rng.randrange(300)]), source) for k, (source, n) in enumerate(counts) for i in range(n)]


KIND = "doc_id long, text string, source string"


def check(found, n):
    assert len(found) == n
    total = {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        own = total.setdefault(r.source, [0, r.source_size, r.target, 0, 0])
        own[0] += r.taken
        own[3] = max(own[3], r.size)
        own[4] += r.size
    for taken, size, target, longest, summed in total.values():
        assert size == summed and abs(taken - target) <= longest + 1e-6
    return total


def test_targets_and_balance(docs_of):
    rows = rows_of(1, [("a", 700), ("b", 20), ("ü", 150), ("z", 90)]) + [(9_000_000 + i, "x y", None) for i in range(30)] + [(1, None, "b")]
    found = mixing.copies(docs_of(rows, KIND), block=64).collect()
    total = check(found, len(rows))
    want = filled({s: total[s][1] for s in ("a", "b", "ü", "z", None)})
    assert all(abs(total[s][2] - want[s]) < 1e-6 for s in want)
    again = mixing.copies(docs_of(rows[::-1], KIND).repartition(5), block=64).collect()
    assert sorted((r.unit, r.size, r.taken) for r in found) == sorted((r.unit, r.size, r.taken) for r in again)


def test_one_source_nulls_and_repeats(docs_of):
    rows = [(7, "a b c", "s")] * 9 + [(None, "a b", "s"), (None, None, "s")]
    check(mixing.copies(docs_of(rows, KIND)).collect(), len(rows))
    assert mixing.copies(docs_of([], KIND)).count() == 0
    assert mixing.copies(docs_of([(1, "", "s")], KIND)).collect()[0].taken == 0
    assert mixing.mixed(docs_of([], KIND)).count() == 0


def test_chances_are_kept():
    """Over many flights each unit is taken as often as its chance says."""
    rng = random.Random(3)
    sizes, taken = [float(rng.randrange(1, 50)) for _ in range(12)], [0] * 12
    chances = [0.1 + 0.07 * k for k in range(12)]
    for k in range(4000):
        after = mixing.fly(sizes, chances, random.Random(k), True)
        assert set(after) <= {0, 1}
        taken = [a + b for a, b in zip(taken, after)]
    assert all(abs(t / 4000 - c) < 0.04 for t, c in zip(taken, chances))


def test_a_block_leaves_two_units_at_most():
    rng = random.Random(4)
    for n in (1, 2, 3, 500):
        sizes = [float(rng.randrange(90)) for _ in range(n)]
        after = mixing.fly(sizes, [0.3] * n, random.Random(n), False)
        assert sum(0 < p < 1 for p in after) <= 2
        if n > 2:
            assert abs(sum(s * p for s, p in zip(sizes, after)) - 0.3 * sum(sizes)) < 1e-6 and abs(sum(after) - 0.3 * n) < 1e-6


def test_rows_are_taken_as_often_as_the_mix_says(docs_of):
    rows = rows_of(2, [("a", 60), ("b", 60), (None, 5)]) + [(None, "n u l l", "a"), (3, "w w w", "b"), (3, "w w w", "b")]
    docs = docs_of(rows, KIND)
    want = sum(r.taken for r in mixing.copies(docs).collect())
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in out.collect()) == want
