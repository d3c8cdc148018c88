import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from viagrid.llm import text

ODD = ["a b c d e f", "A b c", "", None, "x", "a b  c\td e f\n", "\x1cone\x85two é\x0bü", " lead", "x" * 70_000 + " y"]


def shingles(value):
    words = (value or "").encode().split()
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def check(texts):
    found = text.words_of(pa.array(texts, pa.string()))
    per_text = [[bytes(found.data[a:b]) for a, b in zip(found.start[i:j], found.end[i:j])] for i, j in zip(found.first, found.first[1:])]
    assert per_text == [(t or "").encode().split() for t in texts]
    seen = {}
    for word, value in zip([w for ws in per_text for w in ws], found.hashes()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    assert [len(s) for s in text.shingle_sets(pa.array(texts, pa.string()))] == [len(shingles(t)) for t in texts]


def test_odd_texts():
    check(ODD)
    check([])
    check([None, ""])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \t\né\x1f", max_size=40)), max_size=12))
def test_any_texts(texts):
    check(texts)


def test_a_slice_has_its_own_texts():
    whole = pa.array(ODD, pa.string())
    for a, b in zip(text.shingle_sets(whole.slice(3, 4)), list(text.shingle_sets(whole))[3:7]):
        assert np.array_equal(a, b)


@pytest.mark.parametrize("chunk", [1, 5, 1000])
def test_hashes_do_not_depend_on_chunks(monkeypatch, chunk):
    whole = text.words_of(pa.array(ODD, pa.string())).hashes(True)
    monkeypatch.setattr(text, "CHUNK_BYTES", chunk)
    assert np.array_equal(text.words_of(pa.array(ODD, pa.string())).hashes(True), whole)


def test_row_ranges_cover_all_rows():
    ranges = list(text.by_bytes(pa.array(ODD, pa.string()), 20))
    assert [r for a, b in ranges for r in range(a, b)] == list(range(len(ODD)))


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("letters", ["ab", "xy", "01", "é日"])
def test_words_that_collide_under_any_polynomial(letters):
    pairs = [(thue_morse(1 << k, letters), thue_morse(1 << k, letters[::-1])) for k in range(1, 13)]
    texts = [" ".join([word] * 5) for pair in pairs for word in pair]
    for family in (0, 1):
        hashes = text.words_of(pa.array([w for pair in pairs for w in pair])).hashes(family=family)
        assert len(set(hashes.tolist())) == 2 * len(pairs)
    sets = list(text.shingle_sets(pa.array(texts)))
    assert len({s.tobytes() for s in sets}) == len(texts)


def test_the_two_hashes_are_independent():
    words = text.words_of(pa.array([" ".join(f"{k:x}" for k in range(5000))]))
    one, two = words.hashes(), words.hashes(family=1)
    agree = [bin(int(a ^ b)).count("1") for a, b in zip(one, two)]
    assert 31.5 < sum(agree) / len(agree) < 32.5
