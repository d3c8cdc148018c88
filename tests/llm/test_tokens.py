import zlib
from array import array

import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from viagrid.llm import tokens, wavelet
from viagrid.llm.files import create, opened

WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "Hello, world's end", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "ΑΣ ΑΣ'S x́ ́a Ångström İx", "\x1cab a\x85b a\xa0b c", "que&&& " * 300, "x" * 20_000 + " y", "\U0001f600‍😀 😀", "J\u030c I\u0307. …, a…. ’s. it's. <|Endoftext|>, B. ?! .a 5.5,"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORD)
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_ids_are_the_librarys(library):
    encoder = tokens.Encoder(WORD)
    assert encoder.by_word
    for _ in range(2):
        ids = {}
        for first, flat, bounds in encoder.encoded(pa.array(ODD, pa.string())):
            ids |= {first + k: flat[bounds[k] : bounds[k + 1]].tolist() for k in range(len(bounds) - 1)}
        assert [ids[k] for k in range(len(ODD))] == [library(t) for t in ODD]
    assert encoder.counts(pa.array(ODD, pa.string())).tolist() == [len(library(t)) for t in ODD]
    assert not len(encoder.counts(pa.array([], pa.string())))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text(alphabet="aJK.,!?' é<|>\u030c\u0307\n1", max_size=30)), max_size=6))
def test_any_texts(texts):
    tokenizer = Tokenizer.from_file(WORD)
    encoder = tokens.encoder(WORD)
    assert encoder.counts(pa.array(texts, pa.string())).tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_a_full_table_begins_anew(library):
    encoder = tokens.Encoder(WORD)
    encoder.table.most = 4
    for text in ODD * 2:
        assert encoder.counts(pa.array([text], pa.string())).tolist() == [len(library(text))]


def test_words_that_share_a_hash_keep_their_own_ids(library, monkeypatch):
    letters = ["".join("ab"[(bin(i).count("1") + turn) % 2] for i in range(1 << k)) for k in range(1, 13) for turn in (0, 1)]
    texts = [*letters, " ".join(letters), *ODD, " ".join(f"w{k} x{k}." for k in range(300))]

    def check(encoder):
        for _ in range(2):
            for first, flat, bounds in encoder.encoded(pa.array(texts, pa.string())):
                for k in range(len(bounds) - 1):
                    assert flat[bounds[k] : bounds[k + 1]].tolist() == library(texts[first + k])

    check(tokens.Encoder(WORD))
    whole = tokens.Words.hashes
    # nearly all words share a key
    monkeypatch.setattr(tokens.Words, "hashes", lambda words, fold=False, family=0: whole(words, fold, family) % (7 if family == 0 else 1 << 63))
    check(tokens.Encoder(WORD))
    small = tokens.Encoder(WORD)
    small.table.most = 50
    check(small)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_encode_whole_texts(name):
    path = public_tokenizers.path(name)
    encoder = tokens.Encoder(path)
    assert not encoder.by_word
    if name.endswith(".json"):
        tokenizer = Tokenizer.from_file(path)
        want = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in ODD]
    else:
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in ODD])]
    assert encoder.counts(pa.array(ODD, pa.string())).tolist() == want


def test_counts_query(docs_of, library):
    rows = list(enumerate(ODD)) + [(None, "a b"), (2, ODD[2])]
    found = {(r.doc_id, r.n_tokens): r for r in tokens.token_counts(docs_of(rows), WORD, 100).collect()}
    for k, t in rows:
        row = found[k, len(library(t))]
        assert row.n_bytes == len((t or "").encode()) and row.over_limit == (row.n_tokens > 100)
    assert tokens.token_counts(docs_of([]), WORD).count() == 0


@pytest.mark.parametrize("block", [16, 1 << 16])
def test_a_shard_answers_like_its_list(tmp_path, monkeypatch, block):
    import numpy as np

    monkeypatch.setattr(wavelet, "BLOCK_BITS", block)
    monkeypatch.setattr(wavelet, "_BLOCK_BYTES", block // 8)
    rng = np.random.default_rng(5)
    for n, high in ((1, 2), (700, 49_408), (900, 3), (200, 1 << 20)):
        ids = rng.integers(0, high, n).astype(np.uint32)
        with create(f"file://{tmp_path}/a/{n}") as out:
            wavelet.written(out, ids, np.array([4]), np.array([False]), np.array([0]))
        with opened(f"file:{tmp_path}/a/{n}") as file:
            shard = wavelet.Shard(file)
            assert shard.whole().tolist() == ids.tolist()
            assert [shard.access(i) for i in range(0, n, 7)] == ids[::7].tolist()
            for token in {*ids[:20].tolist(), high - 1, high * 9}:
                places = np.flatnonzero(ids == token)
                assert shard.count(token) == len(places)
                assert shard.count(token, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
                assert [shard.occurrence(token, k) for k in range(len(places))] == places.tolist()
                with pytest.raises(IndexError):
                    shard.occurrence(token, len(places))


def test_shards_hold_all_documents_in_order(docs_of, library, monkeypatch):
    rows = [(k * 3, t) for k, t in enumerate(ODD)] + [(None, "x"), (6, ODD[2]), (6, "other")]
    found = wavelet.read_documents(wavelet.write_shards(docs_of(rows), WORD)).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((k for k, _ in rows), key=lambda k: -1 if k is None else k)
    assert [r.start for r in found] == [sum(x.n_tokens for x in found[:i]) for i in range(len(found))]
    want = sorted((repr(k), len(library(t)) + 1, zlib.crc32(array("I", [*library(t), 1]).tobytes())) for k, t in rows)
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == want
    assert wavelet.read_documents(wavelet.write_shards(docs_of([]), WORD)).count() == 0
