import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import SMALL
from viagrid.llm import bpe
from viagrid.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


def same(vocabulary, library, texts):
    ids = vocabulary.encode(texts)
    for text, found in zip(texts, ids):
        assert found.tolist() == library.encode_ordinary(text), repr(text[:80])
    assert vocabulary.decode(ids) == [t.encode() for t in texts]


def test_texts_as_the_library_encodes_them(vocabulary, library):
    same(vocabulary, library, [
        "", " ", "\n", "a", "It's  we'll\t\t don'T\r\n\r\n x", "  two  blanks  ", "12345 67", "<|endoftext|> <|x|>", "\x00\x1c\x85  ﻿",
        "naïve café Übergrößenträger", "日本語のテキストと中文文本", "Здравствуй, мир!", "👩‍👩‍👧‍👦🏳️‍🌈", "á̂̃ ﷽ ½", "zqxjkvbnwpqjhgfdsa" * 20, "=" * 700,
    ])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(vocabulary, library, texts):
    same(vocabulary, library, texts)


def test_query_and_heap_contract_alike(vocabulary, library):
    draw = random.Random(3)
    words = ["".join(draw.choice(alphabet) for _ in range(size)).encode() for alphabet in ("ab", "the", "etaoinshrdlu", " \n", "字文本日") for size in (2, 9, 40, 120) for _ in range(5)]
    (lengths, ids), = vocabulary._contracted(words)
    for word, found in zip(words, np.split(ids, np.cumsum(lengths)[:-1])):
        want = library._core_bpe.encode_single_piece(word)
        long = vocabulary._contracted_long(word).tolist()
        if word not in vocabulary.ranks:
            assert found.tolist() == long == want


def test_long_texts_and_long_matches(vocabulary, library):
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 9))) for _ in range(400_000)]
    long = " ".join(words)
    assert len(list(bpe.parts_of(long))) > 1 and "".join(bpe.parts_of(long)) == long
    same(vocabulary, library, [long, "a" * 50_000, "ab" * 30_000, " " * 30_000 + "x", "字" * 3_000, "".join(draw.choice("etaoin") for _ in range(20_000))])
    assert vocabulary.encode(["a" * 1_000_000])[0].size > 0


def test_a_full_worker_begins_anew(library):
    small = bpe.Vocabulary(bpe.read_ranks(PATH), public_tokenizers.PATTERN, kept=5)
    for _ in range(2):
        for _ in range(3):
            same(small, library, ["one two three four five six seven eight zqx zqy", "zqx one"])
            same(small, library, [" zqx one"])


def test_unknown_ids_are_an_error(vocabulary):
    with pytest.raises(ValueError):
        vocabulary.decode([np.array([1, 70_000])])


def test_rows_nulls_and_clashing_columns(spark, docs_of, library):
    rows = [(1, "It's a cat"), (1, "It's a cat"), (2, None), (3, ""), (None, "x  y"), (4, "\n" * 5)]
    found = bpe.decoded(bpe.encoded(docs_of(rows), PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN).collect()
    assert sorted(((r.doc_id, bytes(r.decoded), r.n_tokens, bytes(r.ids)) for r in found), key=repr) == sorted(
        ((k, (t or "").encode(), len(ids := library.encode_ordinary(t or "")), np.array(ids, "<u4").tobytes()) for k, t in rows), key=repr)
    again = bpe.round_trip(docs_of(rows), PATH, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, found), key=repr)
    assert bpe.encoded(docs_of([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_equals_the_library(spark, library):
    found = {r.doc_id: r for r in QUERIES["op12_byte_bpe"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert (found[doc_id].n_tokens, found[doc_id].ids_sha256, found[doc_id].decoded_sha256) == want
