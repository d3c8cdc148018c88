"""Secret scans: fixed patterns, and values in credential contexts by guess cost.

A value after a credential's name is judged by the least number of guesses that
any segmentation into common words, dates, repeats, keyboard walks and brute-force
spans leaves an attacker, found by dynamic programming. Values that are cheap to
guess (placeholders) are no secrets; dear ones are reported where no pattern
covers them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run of 24 or more
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

#: Names before a value that make it a credential.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth(?:orization)?|bearer)"""
    r"""["']?\x20*(?:=>|:=|[:=])\x20*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'<>]+))""",
    re.ASCII | re.IGNORECASE,
)
_STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")
#: Common words of passwords and placeholders, most frequent first (fixed values).
WORDS = (
    "password", "passwd", "pass", "admin", "welcome", "login", "letmein", "secret", "token", "test", "example", "changeme", "default",
    "user", "root", "guest", "master", "dragon", "monkey", "shadow", "sunshine", "princess", "football", "baseball", "superman",
    "iloveyou", "trustno", "hello", "freedom", "whatever", "hunter", "love", "summer", "winter", "spring", "autumn", "january", "monday",
    "none", "null", "true", "false", "empty", "string", "value", "here", "your", "my", "the", "key", "api", "access", "demo", "sample",
    "dummy", "placeholder", "redacted", "hidden", "undefined", "todo", "required", "optional", "enter", "this", "is", "not", "set",
    "company", "server", "database", "system", "public", "private", "temp", "office", "home", "work", "internet", "computer", "mobile",
)
#: Keyboard rows whose neighbours make a walk (fixed values).
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
#: log10 of the guesses from which a value is a secret; of a word-like run of letters that no list has; of each cut between segments.
LEAST_GUESSES, UNKNOWN_WORD, CUT = 8.0, 5.0, 0.3
#: log10 of the guesses that a repeat, a walk and each turn of a walk add, however long they are.
REPEAT, WALK, TURN = 1.0, log10(47) + 1.0, 0.35
#: A value of over LONG characters is judged with every repeat of a unit of up to LONG_UNIT shortened, and repeats of longer units sought up to MOST_UNIT.
LONG, LONG_UNIT, MOST_UNIT, SHORTENED = 1024, 64, 512, 256
#: Characters of a long value that are looked at first; where they cost enough already, the rest needs no look.
OPENING = 4096
#: How often letters occur in a hundred letters of English (fixed values).
LETTERS = {
    "a": 8.2, "b": 1.5, "c": 2.8, "d": 4.3, "e": 12.7, "f": 2.2, "g": 2.0, "h": 6.1, "i": 7.0, "j": 0.15, "k": 0.8, "l": 4.0, "m": 2.4,
    "n": 6.7, "o": 7.5, "p": 1.9, "q": 0.1, "r": 6.0, "s": 6.3, "t": 9.1, "u": 2.8, "v": 1.0, "w": 2.4, "x": 0.15, "y": 2.0, "z": 0.07,
}
#: A run of letters is like a word if its letters cost no more than this in the mean and no more consonants follow each other.
WORD_LETTER, WORD_CONSONANTS = 1.45, 3
_LEET = str.maketrans("4@301!5$7", "aaeoiisst")
_RANKS = {w: k for k, w in reversed(list(enumerate(WORDS, 1)))}
_LONGEST = max(map(len, WORDS))
_NEAR = {}
for _y, _row in enumerate(ROWS):
    for _x, _c in enumerate(_row):
        _NEAR[_c] = {ROWS[b][a] for b in (_y - 1, _y, _y + 1) if 0 <= b < 4 for a in (_x - 1, _x, _x + 1) if 0 <= a < len(ROWS[b])} - {_c}
_DATES = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
_LETTERS = re.compile(r"[a-z]{4,14}|[A-Z][a-z]{3,13}|[A-Z]{4,14}")
_CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]{%d}" % (WORD_CONSONANTS + 1))
_LETTER_COST = {c: -log10(share / 100) for c, share in LETTERS.items()}
_REACH = 16  # no word, date or word-like run is longer


def _brute(c: str) -> float:
    return 1.0 if c.isdigit() and c.isascii() else log10(26) if c.isalpha() and c.isascii() else log10(33) if c.isascii() else 2.0


def _word_cost(part: str) -> float | None:
    """Guesses of a common word, with its case and its swapped letters."""
    lower = part.lower()
    plain = lower if lower in _RANKS else lower.translate(_LEET)
    rank = _RANKS.get(plain)
    if rank is None:
        return None
    case = 0.0 if part == lower else 0.3 if part == part.upper() or part == part.capitalize() else 0.3 * sum(c.isupper() for c in part)
    return log10(rank + 1) + case + 0.3 * (plain != lower)


def _word_like(run: str) -> bool:
    """Whether a run of letters may stand in some list of words: usual letters, vowels among them."""
    lower = run.lower()
    return sum(map(_LETTER_COST.__getitem__, lower)) <= WORD_LETTER * len(lower) and not _CONSONANTS.search(lower)


@dataclass
class Run:
    """A stretch of which every part of at least ``least`` characters is one segment, at ``price`` and TURN for each turn within it.

    ``turns`` counts the turns up to each place; ``best`` is the cheapest way to
    a place that a part may begin at, less the turns up to there.
    """

    start: int
    end: int
    least: int
    price: float
    turns: list[int] | None = None
    best: float = float("inf")


def _stretches(flags: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Where at least ``least`` flags in a row are set: first and end."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= least]


def lowered(value: str) -> str:
    """Lower case, letter by letter; one that would become two stays."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def _walks(value: str) -> list[Run]:
    """Keyboard walks, and runs of letters or digits in the order of the codes."""
    lower = lowered(value)
    out = []
    for near in (lambda a, b: b in _NEAR.get(a, ()), lambda a, b: a.isalnum() and abs(ord(a) - ord(b)) == 1):
        linked = np.fromiter(map(near, lower, lower[1:]), bool, max(0, len(lower) - 1))
        found = _stretches(linked, 2)
        if not found:
            continue
        steps = np.diff(np.array([ord(c) for c in lower]))
        turned = np.zeros(len(lower), np.int64)
        turned[2:] = (steps[1:] != steps[:-1]) & linked[1:] & linked[:-1]
        turns = np.cumsum(turned).tolist()
        out += [Run(a, b + 1, 3, WALK, turns) for a, b in found]
    return out


def _repeats(value: str) -> list[Run]:
    """Stretches that copy what stands a unit before them, at least a whole unit; those within one of a shorter unit are left out."""
    codes = np.array([ord(c) for c in value])
    out: list[Run] = []
    for unit in range(1, len(codes) // 2 + 1 if len(codes) <= LONG else MOST_UNIT + 1):
        for a, b in _stretches(codes[unit:] == codes[:-unit], max(unit, 3)):
            if not any(r.start <= a + unit and b + unit <= r.end for r in out):
                out.append(Run(a + unit, b + unit, max(unit, 3), REPEAT))
    return out


def _shortened(value: str) -> str:
    """A long value with the middle of long repeats taken out by whole units, which changes no segment's price."""
    if len(value) <= LONG:
        return value
    codes = np.array([ord(c) for c in value])
    for unit in range(1, LONG_UNIT + 1):
        kept = np.ones(len(codes), dtype=bool)
        for a, b in _stretches(codes[unit:] == codes[:-unit], 2 * SHORTENED):
            kept[a + SHORTENED : a + SHORTENED + (b - a - SHORTENED) // unit * unit] = False
        codes = codes[kept]
    return "".join(map(chr, codes))


def guess_cost(value: str, enough: float = float("inf")) -> float:
    """log10 of the guesses of the cheapest segmentation of ``value``; some figure over ``enough`` once it must be over.

    Costs grow with the number of segments and brute-force characters; a repeat
    or a walk costs the same however long it is, but for the walk's turns. The
    work is linear in the value's length.
    """
    if len(value) > 2 * OPENING and enough < float("inf"):
        cost, place = _cheapest(value[:OPENING], enough)
        if place < OPENING - MOST_UNIT:  # no repeat that begins before is cut off by the end of the opening
            return cost
    return _cheapest(_shortened(value), enough)[0]


def _cheapest(value: str, enough: float) -> tuple[float, int]:
    """The cost, and the place at which it was found: the end, unless it is over ``enough`` earlier."""
    n = len(value)
    runs = sorted(_walks(value) + _repeats(value), key=lambda r: r.start)
    window = max([_REACH, *(r.least for r in runs)])
    ended = [0.0] + [float("inf")] * n  # cheapest way to a place that ends with another segment than a brute-force span
    brute = [float("inf")] * (n + 1)
    least = [0.0] + [float("inf")] * n
    active: list[Run] = []
    following, cheap = 0, 0
    for i in range(n + 1):
        if i:
            while following < len(runs) and runs[following].start < i:
                active.append(runs[following])
                following += 1
            for r in active:
                begin = i - r.least
                if begin >= r.start:
                    at = least[begin] + (CUT if begin else 0.0)
                    r.best = min(r.best, at - (TURN * r.turns[begin + 1] if r.turns else 0.0))
                ended[i] = min(ended[i], r.best + r.price + (TURN * r.turns[i - 1] if r.turns else 0.0))
            active = [r for r in active if r.end > i]
            least[i] = min(ended[i], brute[i])
            if least[i] <= enough:
                cheap = i
            elif i - cheap > window:
                return least[i], i
        if i == n:
            break
        here = least[i] + (CUT if i else 0.0)
        brute[i + 1] = min(brute[i], here) + _brute(value[i])
        for j in range(i + 2, min(n, i + _LONGEST) + 1):
            cost = _word_cost(value[i:j])
            if cost is not None:
                ended[j] = min(ended[j], here + cost)
        if i == 0 or not value[i - 1].isalpha():
            run = _LETTERS.match(value, i)
            if run and (run.end() == n or not value[run.end()].isalpha()) and _word_like(run[0]):
                ended[run.end()] = min(ended[run.end()], here + UNKNOWN_WORD)
        date = _DATES.match(value, i)
        if date:
            ended[date.end()] = min(ended[date.end()], here + (log10(200) if date.end() - i == 4 else log10(200 * 365)))
    return least[n], n


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, ordered."""
    found = []
    lower = text.lower()
    if any(stem in lower for stem in ("passw", "secret", "token", "key")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def costly_values(text: str, base: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
    """Values in credential contexts, outside the base spans, that take at least ``10 ** least`` guesses."""
    lower = text.lower()
    if not any(stem in lower for stem in _STEMS):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        group = m.lastindex
        value = m[group] if group < 3 else m[group].rstrip(".,;:!?)]}")
        a, b = m.start(group), m.start(group) + len(value)
        if len(value) < 4 or any(x <= a and b <= y for x, _, y in base):
            continue
        if guess_cost(value, least) >= least:
            out.append((a, 3, b))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, marks, spans = [[], [], [], []], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                every = sorted(base + costly_values(text, base, least))
                for k in range(4):
                    counts[k].append(sum(kind == k for _, kind, _ in every))
                marks.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(marks, pa.string()), pa.array(spans, pa.string()), pa.array(counts[3], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])

    return run


def secrets(docs: DataFrame, least: float = LEAST_GUESSES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_guess of every row of ``docs``.

    Places count code points, ends are exclusive. A null or empty text has no
    span; repeated rows and null ids are scanned like any other; a value in a
    context is judged whole, however long. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"
    return rows.mapInArrow(_scan(least), kind)
