"""Token ids and token counts of whole texts, encoded in Arrow batches.

Where a tokenizer drops white space, the ids of a text are those of its words
one after another, so texts are split at white space (and before final marks,
where the tokenizer parts them too): each distinct piece is encoded once per
worker and kept in a bounded table. Other tokenizers encode whole texts in
batches balanced by bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viagrid.llm.text import Words, buffer_of, by_bytes, mixed, words_of

#: Text encoded at a time, words kept by a worker, words joined into one call, bytes of a call.
BATCH_BYTES, KEPT_WORDS, JOINED_WORDS, CALL_BYTES = 4 << 20, 1_200_000, 500, 1 << 18
#: Final marks that are parted off a word; a longer run stays with it.
MOST_MARKS = 8
_FINAL = np.zeros(256, dtype=bool)
_FINAL[list(b".,;:!?")] = True
_PLAIN_END = np.zeros(256, dtype=bool)
_PLAIN_END[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NO_FOLD = np.zeros(256, dtype=bool)
_NO_FOLD[[ord("<"), *range(128, 256)]] = True


def units_of(words: Words) -> Words:
    """Words with final marks parted off and, where that changes no id, A-Z folded.

    Behind an ASCII letter or digit a run of marks is a piece of its own for a
    tokenizer that parts letters, digits and marks. Only words of ASCII without
    ``<``, which may begin a special token, are folded.
    """
    if not len(words.start):
        return words
    cut, ending = words.end.copy(), np.arange(len(words.end))
    for _ in range(MOST_MARKS):
        ending = ending[_FINAL[words.data[cut[ending] - 1]]]
        cut[ending] -= 1
        ending = ending[cut[ending] > words.start[ending]]
    split = (cut > words.start) & (cut < words.end)
    split &= _PLAIN_END[words.data[cut - 1]]
    pieces = np.concatenate((np.zeros(1, np.int64), np.cumsum(1 + split)))
    start, end = np.repeat(words.start, 1 + split), np.repeat(words.end, 1 + split)
    tails = pieces[1:][split] - 1
    start[tails], end[tails - 1] = cut[split], cut[split]
    odd = np.logical_or.reduceat(_NO_FOLD[words.data], words.start)
    kept = np.repeat(np.append(True, odd), np.diff(np.concatenate(([0], words.start, [len(words.data)]))))
    data = np.where(kept, words.data, _LOWER[words.data])
    return Words(data, start, end, pieces[words.first])


class WordTable:
    """Ids of the words met so far, by word hash; emptied when full.

    Each word has a second hash beside its key, so a word that only shares
    another's key is told apart.
    """

    def __init__(self, most: int = KEPT_WORDS):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.seconds = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.lengths = np.empty(0, np.int32)
        self.at = np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted keys stand, and which of them are absent."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.ones(len(keys), dtype=bool)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] != keys

    def add(self, keys: np.ndarray, seconds: np.ndarray, lengths: np.ndarray, at: np.ndarray, ids: np.ndarray) -> None:
        """New sorted keys: their second hashes, how many ids each has, and where they begin in ``ids``."""
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.seconds = np.insert(self.seconds, where, seconds)
        self.lengths = np.insert(self.lengths, where, lengths)
        self.at = np.insert(self.at, where, at + len(self.pool))
        self.pool = np.concatenate((self.pool, ids))


class Encoder:
    """Encodes batches of texts as the library of the vocabulary file does."""

    def __init__(self, path: str):
        self.path = path
        self.table = WordTable()
        self.by_word = False
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        probe = "a,b'S ½é x9́ ́y"
        self.by_word = all(self._whole([f"{probe}{s}{probe}"])[0] == self._whole([probe])[0] * 2 for s in "\x20\t\n\x0b\x0c\r")
        self.by_word &= self._whole([probe])[0] == [i for ids in self._whole(probe.split(" ")) for i in ids]
        marked, parts = "Ab1.,;:!? x9?!", ["ab1", ".,;:!?", "x9", "?!"]
        self.parted = self.by_word and self._whole([marked])[0] == [i for ids in self._whole(parts) for i in ids]
        added = self.tokenizer.get_added_tokens_decoder().items()
        self.parted &= all("<" in t.content for _, t in added)
        plain = [(i, t.content) for i, t in added if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.mark = min(plain, default=None)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        if self.path.endswith(".model"):
            return self.pieces.encode(texts, num_threads=1)
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths, places and ids of words; many plain ones share a call, parted by a special token."""
        texts = [w.decode("utf-8") for w in words]
        mark, string = self.mark or (0, "")
        alone = np.array([not string or string[0] in t or len(t) > CALL_BYTES // JOINED_WORDS for t in texts])
        plain = [t for t, single in zip(texts, alone) if not single]
        calls = [string.join(plain[i : i + JOINED_WORDS]) for i in range(0, len(plain), JOINED_WORDS)]
        flat = []
        for i in range(0, len(calls), 64):
            for ids in self._whole(calls[i : i + 64]):
                flat += [np.array(ids, np.uint32), np.array([mark], np.uint32)]
        joined = np.concatenate([*flat, np.empty(0, np.uint32)])
        is_mark = joined == mark
        lengths = np.empty(len(texts), np.int64)
        lengths[~alone] = np.diff(np.append(-1, np.flatnonzero(is_mark))) - 1 if plain else 0
        single = [np.array(self._whole([texts[k]])[0], np.uint32) for k in np.flatnonzero(alone)]
        lengths[alone] = [len(x) for x in single]
        ids = np.concatenate([joined[~is_mark] if plain else joined, *single])
        order = np.concatenate((np.flatnonzero(~alone), np.flatnonzero(alone)))
        at = np.empty(len(texts), np.int64)
        at[order] = np.cumsum(lengths[order]) - lengths[order]
        return lengths, at, ids

    def _placed(self, words: Words) -> np.ndarray:
        """The place in the table of every unit of a batch.

        Units whose second hash is not that of their key's word get another key,
        made of both hashes, until every unit stands with its own word.
        """
        keys, seconds = words.hashes(), words.hashes(family=1)
        while True:
            at = self._looked_up(words, keys, seconds)
            apart = self.table.seconds[at] != seconds
            if not apart.any():
                return at
            keys[apart] = mixed(keys[apart] ^ seconds[apart])

    def _looked_up(self, words: Words, keys: np.ndarray, seconds: np.ndarray) -> np.ndarray:
        """The place of every unit's key, added with the first unit that has it where it is absent."""
        keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at, absent = self.table.places(keys)
        if absent.any():
            if len(self.table.keys) + int(absent.sum()) > self.table.most:
                self.table.clear()
                absent[:] = True
            new = np.flatnonzero(absent)
            data = words.data.tobytes()
            begins, ends = words.start[first[new]].tolist(), words.end[first[new]].tolist()
            self.table.add(keys[new], seconds[first[new]], *self._words([data[a:b] for a, b in zip(begins, ends)]))
            at, _ = self.table.places(keys)
        return at[inverse]

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text; null counts as empty."""
        out = [np.empty(0, np.int64)]
        for i, j in by_bytes(column, BATCH_BYTES):
            part = column.slice(i, j - i)
            if not self.by_word:
                out.append(np.array([len(x) for x in self._whole([t or "" for t in part.to_pylist()])], np.int64))
                continue
            words = units_of(words_of(part)) if self.parted else words_of(part)
            sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.table_lengths(words))))
            out.append(sums[words.first[1:]] - sums[words.first[:-1]])
        return np.concatenate(out)

    def table_lengths(self, words: Words) -> np.ndarray:
        at = self._placed(words)
        return self.table.lengths[at].astype(np.int64)

    def encoded(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For runs of texts: the first text's row, the ids of all, and their bounds."""
        for i, j in by_bytes(column, BATCH_BYTES):
            part = column.slice(i, j - i)
            if not self.by_word:
                ids = [np.array(x, np.uint32) for x in self._whole([t or "" for t in part.to_pylist()])]
                yield i, np.concatenate([*ids, np.empty(0, np.uint32)]), np.cumsum([0, *map(len, ids)])
                continue
            words = units_of(words_of(part)) if self.parted else words_of(part)
            at = self._placed(words)
            lengths = self.table.lengths[at].astype(np.int64)
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            source = np.arange(total) + np.repeat(self.table.at[at] - (ends - lengths), lengths)
            yield i, self.table.pool[source], np.concatenate((np.zeros(1, np.int64), ends))[words.first]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; it keeps its words between tasks."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, bounds = buffer_of(batch.column(1))
            columns = [batch.column(0), pa.array(np.diff(bounds)), pa.array(encoder(path).counts(batch.column(1)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``.

    ``path`` names a vocabulary file that every executor has. No special tokens
    are added; a null or empty text has no tokens; repeated rows and null ids
    are counted like any other, other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(_counted(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
