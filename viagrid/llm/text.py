"""Words, word hashes and shingle sets of whole Arrow batches of texts.

A word is a run of bytes other than space and 0x09 to 0x0D. Everything here is
vectorised over the byte buffer of a batch; no text is cut or skipped. A null
text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at a time; a longer word is hashed in one go.
CHUNK_BYTES = 1 << 18
#: Words in a shingle.
SHINGLE_WORDS = 5

_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """The bits of 64-bit values, spread over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    start = (seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & _MASK
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(start))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = seeded(SHINGLE_WORDS, 2) | np.uint64(1)


class _Family:
    """Keys of one hash: a value per byte, the same with A-Z as a-z, and an odd key per place in a word.

    Every place has a key of its own, so no pattern of bytes makes two words
    collide whatever the keys are, as powers of one base would.
    """

    def __init__(self, seed: int):
        self.seed = seed
        self.bytes = seeded(256, seed)
        self.folded = self.bytes.copy()
        self.folded[65:91] = self.bytes[97:123]
        self.places = np.empty(0, np.uint64)

    def keys(self, n: int) -> np.ndarray:
        """Keys of the first places, as many as the longest run hashed so far needed."""
        if len(self.places) < n:
            self.places = seeded(max(n, CHUNK_BYTES), self.seed + 1) | np.uint64(1)
        return self.places


#: Two independent hashes.
_FAMILIES = (_Family(1), _Family(11))


@dataclass
class Words:
    """The words of a batch in order: byte spans, hashes, and where each text's words begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of text i: words first[i] to first[i + 1]

    def hashes(self, fold: bool = False, family: int = 0) -> np.ndarray:
        """A 64-bit hash per word; ``fold`` takes A-Z as a-z, ``family`` is one of two independent hashes."""
        keys = _FAMILIES[family]
        table = keys.folded if fold else keys.bytes
        out = np.empty(len(self.start), dtype=np.uint64)
        i = 0
        while i < len(self.start):
            base = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, base + CHUNK_BYTES, "right")))
            piece = table[self.data[base : self.end[j - 1]]]
            lengths = self.end[i:j] - self.start[i:j]
            # place of each byte in its word: bytes between words get any place, they are not summed
            offset = self.start[i:j] - base
            place = np.arange(len(piece)) - np.repeat(offset, np.diff(np.append(offset, len(piece))))
            piece = piece * keys.keys(int(place.max()) + 1)[place]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(piece)))
            out[i:j] = mixed(sums[offset + lengths] - sums[offset] + lengths.astype(np.uint64))
            i = j
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def words_of(column: pa.Array) -> Words:
    data, bounds = buffer_of(column)
    if not len(data):
        return Words(data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64))
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    # a word ends with its text
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    begins[edge] = solid[edge]
    ends[edge - 1] = solid[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, bounds))


def by_bytes(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text each; a longer text is alone."""
    bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))))
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, "right")) - 1)
        yield i, j
        i = j


def shingle_hashes(words: Words, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and where each text's begin.

    A text of fewer than ``SHINGLE_WORDS`` words has its whole sequence as its
    one shingle; one without words has none.
    """
    hashes = words.hashes(fold)
    counts = words.counts()
    owned = np.where(counts >= SHINGLE_WORDS, counts - SHINGLE_WORDS + 1, (counts > 0).astype(np.int64))
    first = np.concatenate((np.zeros(1, np.int64), np.cumsum(owned)))
    total = int(first[-1])
    # the word at which each shingle begins
    at = np.arange(total) - np.repeat(first[:-1], owned) + np.repeat(words.first[:-1], owned)
    length = np.repeat(np.minimum(counts, SHINGLE_WORDS), owned)
    sums = length.astype(np.uint64)
    padded = np.concatenate((hashes, np.zeros(SHINGLE_WORDS, np.uint64)))
    for k in range(SHINGLE_WORDS):
        part = padded[at + k] * _PLACES[k]
        sums = sums + (part if k == 0 else np.where(k < length, part, np.uint64(0)))
    return mixed(sums), first


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text of a column, ascending."""
    for i, j in by_bytes(column, CHUNK_BYTES):
        hashes, first = shingle_hashes(words_of(column.slice(i, j - i)))
        for k in range(j - i):
            yield np.unique(hashes[first[k] : first[k + 1]])
