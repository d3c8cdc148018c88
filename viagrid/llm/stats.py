"""Exact counts and shape statistics of whole texts, a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viagrid.llm.text import CHUNK_BYTES, Words, buffer_of, by_bytes, words_of

#: Exact counts of a text.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shape of a text, each a bounded number; all are 0 for a text without words.
SHAPES = (
    "log_words", "log_word_length", "symbols_per_word", "repeat_words", "dup_lines", "distinct_words", "top_word", "upper_share",
    "digit_share", "mark_share", "shout_share", "bar_share", "long_words", "log_line_words", "non_ascii",
)

_KINDS = np.zeros(256, dtype=np.uint8)
for _kind, _bytes in enumerate((range(65, 91), range(48, 58), b".,;:", b"!?", b"|", b"#*$%&<>", range(0xC0, 0x100), range(0x80, 0xC0), range(97, 123)), 1):
    _KINDS[list(_bytes)] = _kind
UPPER, DIGIT, MARK, SHOUT, BAR, SYMBOL, LEAD, TRAIL, LOWER = range(1, 10)


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set within each text."""
    at = np.flatnonzero(flags)
    return np.diff(np.searchsorted(at, bounds))


def _dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def _repeats(hashes: np.ndarray) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(hashes) < 4:
        return 0
    windows = hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[2:] * np.uint64(0x165667B19E3779F9)
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(hashes) + 2, dtype=bool)
    hit = np.concatenate((order[1:][same], order[:-1][same]))
    for k in range(3):
        twice[hit + k] = True
    return int(twice.sum())


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` and ``SHAPES`` of each text; null counts as empty."""
    words: Words = words_of(column)
    _, bounds = buffer_of(column)
    n = len(column)
    kinds = _KINDS[words.data]
    of = {k: _per_text(kinds == k, bounds) for k in range(1, 10)}
    n_words, lengths = words.counts(), words.end - words.start
    sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)))
    word_chars = sums[words.first[1:]] - sums[words.first[:-1]] - of[TRAIL]
    long_words = _per_word(lengths > 20, words)
    hashes = words.hashes()
    repeats, lines, dup_lines, distinct, top = (np.zeros(n, np.int64) for _ in range(5))
    whole = words.data.tobytes()
    for i in range(n):
        own = hashes[words.first[i] : words.first[i + 1]]
        if not len(own):
            continue
        repeats[i] = _repeats(own)
        lines[i], dup_lines[i] = _dup_lines(whole[bounds[i] : bounds[i + 1]])
        own = np.sort(own)
        ends = np.append(np.flatnonzero(own[1:] != own[:-1]), len(own) - 1)
        distinct[i], top[i] = len(ends), np.diff(ends, prepend=-1).max()
    some, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": of[SYMBOL] + of[BAR], "n_dup_lines": dup_lines, "n_repeat_words": repeats}
    out |= {
        "log_words": np.log1p(n_words), "log_word_length": np.log1p(word_chars / some), "symbols_per_word": np.log1p((of[SYMBOL] + of[BAR]) / some),
        "repeat_words": repeats / some, "dup_lines": dup_lines / np.maximum(lines, 1), "distinct_words": distinct / some, "top_word": top / some,
        "upper_share": of[UPPER] / chars, "digit_share": of[DIGIT] / chars, "mark_share": of[MARK] / some, "shout_share": np.log1p(of[SHOUT] / some),
        "bar_share": of[BAR] / some, "long_words": long_words / some, "log_line_words": np.log1p(n_words / np.maximum(lines, 1)),
        "non_ascii": of[LEAD] / chars,
    }
    return out


def _per_word(flags: np.ndarray, words: Words) -> np.ndarray:
    at = np.flatnonzero(flags)
    return np.diff(np.searchsorted(at, words.first))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("shape", pa.list_(pa.float64()))])
    for batch in batches:
        for i, j in by_bytes(batch.column(1), CHUNK_BYTES):
            part = batch.slice(i, j - i)
            found = text_stats(part.column(1))
            flat = pa.array(np.stack([found[s] for s in SHAPES], axis=1).ravel(), pa.float64())
            shape = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(SHAPES)), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[c], pa.int64()) for c in COUNTS), shape], schema=schema)


def with_stats(docs: DataFrame) -> DataFrame:
    """doc_id, ``COUNTS`` and ``shape`` (the values of ``SHAPES``) of every row of ``docs``."""
    kind = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", shape array<double>"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(_run, kind)
