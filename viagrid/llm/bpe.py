"""Byte-level BPE: encoding and decoding by DuckDB queries within each partition.

A text is parted by the vocabulary's pattern, and each distinct match is encoded
once per worker: its token positions are rows that a recursive query joins with
the merge table, contracting the leftmost pair of least rank of every match
until no pair is left. Decoding joins ids with their spellings and gathers these
by an ordered aggregate. Ids travel as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viagrid.llm.text import by_bytes

#: Bytes of text in a batch, characters parted at a time, ids decoded at a time, distinct matches kept by a worker.
BATCH_BYTES, PART_CHARS, DECODED_IDS, KEPT_MATCHES = 4 << 20, 1 << 20, 1 << 18, 500_000
#: Rows that a recursion may make; a match of L bytes makes at most L * L / 2.
RECURSION_ROWS = 1 << 19
#: Bytes from which on a match is contracted with a heap, as its rows would grow with the square of its length.
LONG_MATCH = 512
#: Memory of a worker's database.
DATABASE_MB = 160

#: Between two characters that are not white space, no match reaches across the front of a single blank.
_SAFE = regex.compile(r"(?<=\S) (?=\S)")

ENCODE_SQL = """
WITH RECURSIVE t(step, word, pos, id) AS (
    SELECT 0, word, pos, id FROM start
    UNION ALL (
        WITH least AS (
            SELECT a.word, min(made::BIGINT * 65536 + a.pos) AS best
            FROM t a JOIN t b ON b.word = a.word AND b.pos = a.pos + 1 JOIN merges ON pair = a.id::BIGINT * 65536 + b.id
            GROUP BY a.word
        )
        SELECT step + 1, word, CASE WHEN pos > best % 65536 THEN pos - 1 ELSE pos END, CASE WHEN pos = best % 65536 THEN best // 65536 ELSE id END::INT
        FROM t JOIN least USING (word) WHERE pos <> best % 65536 + 1
    )
)
SELECT word, list(id ORDER BY pos) AS ids
FROM t JOIN (SELECT word, max(step) AS step FROM t GROUP BY word) USING (word, step)
GROUP BY word ORDER BY word
"""

DECODE_SQL = """
SELECT owner, unhex(array_to_string(list(spelling ORDER BY pos), '')) AS bytes
FROM ids JOIN spellings USING (id) GROUP BY owner
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> pa.Table:
    """Every pair of tokens that makes a token: pair (first * 65536 + second) and made, which is also the pair's rank."""
    rows = [
        (ranks[token[:k]] * 65536 + ranks[token[k:]], made)
        for token, made in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks
    ]
    pairs, made = np.array(rows, np.int64).reshape(-1, 2).T
    return pa.table({"pair": pairs, "made": made.astype(np.int32)})


def parts_of(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """A text in parts of about ``most`` characters whose matches are those of the whole."""
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Vocabulary:
    """Encodes and decodes by one vocabulary; holds its tables and the ids of matches met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kept: int = KEPT_MATCHES):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.all_ids = np.sort(np.fromiter(ranks.values(), np.int64, len(ranks)))
        self.database = duckdb.connect(config={"threads": 1, "memory_limit": f"{DATABASE_MB}MB", "temp_directory": ""})
        spellings = pa.table({"id": pa.array(ranks.values(), pa.int32()), "spelling": [token.hex() for token in ranks]})
        for name, rows in (("merges", merges_of(ranks)), ("spellings", spellings)):
            self.database.register("rows", rows)
            self.database.execute(f"CREATE TABLE {name} AS FROM rows")
            self.database.unregister("rows")
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # its place in the following
        self.lengths, self.first, self.uses = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.int32)

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        self.database.register(name, rows)
        found = self.database.sql(sql).to_arrow_table()
        self.database.unregister(name)
        return found.combine_chunks()

    def _contracted(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Lengths and ids of words, contracted by the recursive query in groups of bounded work."""
        i = 0
        while i < len(words):
            j, rows = i, 0
            while j < len(words) and (j == i or rows + len(words[j]) ** 2 <= 2 * RECURSION_ROWS):
                rows += len(words[j]) ** 2
                j += 1
            data = np.frombuffer(b"".join(words[i:j]), np.uint8)
            lengths = np.array([len(w) for w in words[i:j]])
            places = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            start = pa.table({"word": np.repeat(np.arange(j - i, dtype=np.int32), lengths), "pos": places.astype(np.int32), "id": self.single[data]})
            found = self._query(ENCODE_SQL, "start", start).column("ids").combine_chunks()
            yield np.asarray(pc.list_value_length(found)), np.asarray(found.flatten())
            i = j

    def _contracted_long(self, word: bytes) -> np.ndarray:
        """Ids of one word by the same contractions, the next one taken from a heap."""
        size = len(word)
        ends = list(range(1, size + 1))  # of the token that begins at a place
        before = list(range(-1, size - 1))
        alive = [True] * size
        rank = self.ranks.get
        heap = [(r, k, k + 2) for k in range(size - 1) if (r := rank(word[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, end = heapq.heappop(heap)
            # the pair still stands if the token at k and its neighbour end where they did
            if not alive[k] or ends[k] >= end or ends[ends[k]] != end:
                continue
            alive[ends[k]] = False
            ends[k] = end
            if end < size:
                before[end] = k
                if (r := rank(word[k : ends[end]])) is not None:
                    heapq.heappush(heap, (r, k, ends[end]))
            if before[k] >= 0 and (r := rank(word[before[k] : end])) is not None:
                heapq.heappush(heap, (r, before[k], end))
        return np.array([self.ranks[word[k : ends[k]]] for k in range(size) if alive[k]], np.int32)

    def _learn(self, words: list[str]) -> None:
        spelled = [(w, w.encode()) for w in words]
        whole = [(w, x) for w, x in spelled if x in self.ranks]
        long = [(w, x) for w, x in spelled if len(x) > LONG_MATCH and x not in self.ranks]
        rest = [(w, x) for w, x in spelled if len(x) <= LONG_MATCH and x not in self.ranks]
        by_heap = [self._contracted_long(x) for _, x in long]
        lengths = [np.ones(len(whole), np.int64), np.array([len(x) for x in by_heap], np.int64)]
        ids = [np.array([self.ranks[x] for _, x in whole], np.int32), *by_heap]
        for own, found in self._contracted([x for _, x in rest]):
            lengths.append(own)
            ids.append(found)
        self.known.update((w, k) for k, (w, _) in enumerate([*whole, *long, *rest], len(self.known)))
        self.lengths = np.concatenate((self.lengths, *lengths))
        self.pool = np.concatenate((self.pool, *ids))
        self.uses = np.concatenate((self.uses, np.zeros(len(words), np.int64)))
        self.first = np.cumsum(self.lengths) - self.lengths

    def _keep_frequent(self) -> None:
        """Forget the matches met in one call only, or the less frequent half if most were met in more."""
        kept = self.uses >= max(2, np.median(self.uses) if len(self.uses) else 0)
        if kept.sum() * 2 > self.kept:
            kept[:] = False
        number = np.cumsum(kept) - 1
        self.known = {w: int(number[k]) for w, k in self.known.items() if kept[k]}
        self.pool = self.pool[np.repeat(kept, self.lengths)]
        self.lengths, self.uses = self.lengths[kept], self.uses[kept] // 2
        self.first = np.cumsum(self.lengths) - self.lengths

    def _ids(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each match has, and the ids of all."""
        coded = pa.array(matches, pa.large_string()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.kept:
            self._keep_frequent()
            new = [w for w in words if w not in self.known]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.uses[number] += 1
        place = number[np.asarray(coded.indices)]
        lengths = self.lengths[place]
        ends = np.cumsum(lengths)
        return lengths, self.pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.first[place] - (ends - lengths), lengths)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        owners, counts, matches, chars = [], [], [], 0

        def flush() -> None:
            lengths, ids = self._ids(matches)
            sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)))
            for owner, piece in zip(owners, np.split(ids, sums[np.cumsum(counts)][:-1])):
                found[owner].append(piece)

        for k, text in enumerate(texts):
            for part in parts_of(text):
                own = self.pattern.findall(part)
                owners.append(k)
                counts.append(len(own))
                matches += own
                chars += len(part)
                if chars >= PART_CHARS:
                    flush()
                    owners, counts, matches, chars = [], [], [], 0
        if owners:
            flush()
        return [np.concatenate(x) if len(x) > 1 else x[0] for x in found]

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The bytes that each sequence of ids spells; ValueError where an id is none of the vocabulary's."""
        lengths = np.array([len(x) for x in texts], np.int64)
        ids = np.concatenate([*texts, np.empty(0, np.int32)])
        at = np.searchsorted(self.all_ids, ids)
        if (self.all_ids[np.minimum(at, len(self.all_ids) - 1)] != ids).any():
            raise ValueError("an id is not in the vocabulary")
        owners = np.repeat(np.arange(len(texts)), lengths)
        found: list[list[bytes]] = [[] for _ in texts]
        for i in range(0, len(ids), DECODED_IDS):
            own = slice(i, min(i + DECODED_IDS, len(ids)))
            rows = pa.table({"owner": owners[own], "pos": np.arange(own.start, own.stop), "id": ids[own].astype(np.int32)})
            spelled = self._query(DECODE_SQL, "ids", rows)
            for owner, piece in zip(spelled.column("owner").to_pylist(), spelled.column("bytes").to_pylist()):
                found[owner].append(piece)
        return [b"".join(x) for x in found]


_vocabularies: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The worker's vocabulary for a file and pattern; it keeps its matches between tasks."""
    if (path, pattern) not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[path, pattern] = Vocabulary(read_ranks(path), pattern)
    return _vocabularies[path, pattern]


def _encoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("text").cast(pa.large_binary())
            for i, j in by_bytes(raw, BATCH_BYTES):
                ids = vocabulary(path, pattern).encode([(x or b"").decode("utf-8", "replace") for x in raw.slice(i, j - i).to_pylist()])
                columns = [batch.column("doc_id").slice(i, j - i), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    return run


def _decoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in by_bytes(batch.column("ids"), BATCH_BYTES):
                part = batch.slice(i, j - i)
                ids = [np.frombuffer(x or b"", "<u4").astype(np.int64) for x in part.column("ids").to_pylist()]
                spelled = pa.array(vocabulary(path, pattern).decode(ids), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, spelled], names=[*part.schema.names, "decoded"])

    return run


ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = f"{ENCODED}, decoded binary"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row of ``docs``.

    ``path`` names a rank file that every executor has, ``pattern`` what parts a
    text before it is contracted; special tokens are ordinary text. A null text
    is an empty one, without ids; bytes that are no UTF-8 count as U+FFFD;
    repeated rows and null ids are encoded like any other, other columns are
    ignored. Matches of over ``LONG_MATCH`` bytes are contracted in the same
    order with a heap instead of the query.
    """
    return _texts(docs).mapInArrow(_encoded(path, pattern), ENCODED)


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids as :func:`encoded` gives them, and the bytes they spell as ``decoded``.

    Null ids spell nothing; an id outside the vocabulary is an error.
    """
    return rows.select("doc_id", "n_tokens", "ids").mapInArrow(_decoded(path, pattern), DECODED)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """What ``decoded(encoded(docs))`` gives, both by one worker with one vocabulary."""
    encode, decode = _encoded(path, pattern), _decoded(path, pattern)
    return _texts(docs).mapInArrow(lambda batches: decode(encode(batches)), DECODED)
