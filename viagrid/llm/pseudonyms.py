"""Format-preserving pseudonyms of personal data.

Validated card numbers, phone numbers, addresses of machines, dates and mail
addresses become a number in the domain of their format; a keyed Feistel network
permutes that domain and the result is written in the same format. Equal values
get equal pseudonyms in all documents, and who has the key can turn them back.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("card", "phone", "ip", "date", "email")
#: Dates are permuted among the days of these years.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: A card in four fours or in 4, 6 and 4 or 5 digits; where a phone number can end before it, it does.
_FORM = r"[ -]\d{4}[ -](?:\d{4}[ -]\d{4}[ -]\d{4}(?!\d|[ -]\d{4}(?!\d))|\d{6}[ -]\d{4,5}(?!\d))"
_NUMBERS = re.compile(
    r"(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d))"
    r"|(?P<date>(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{4}/\d{1,2}/\d{1,2}|\d{4}\.\d{1,2}\.\d{1,2})(?![\d/-]|\.\d))"
    r"|(?P<phone>(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?"
    r"(?:(?:(?!" + _FORM + r")[ .-]?\d{2,4}){2,3}(?!\d)|(?:[ .-]?\d{2,4}){2,3}(?!\d)))",
    re.ASCII,
)
#: Digit groups with single blanks or hyphens between them, 13 digits or more, and four fours with dots.
_RUN = re.compile(r"(?<!\d)\d(?:[ -]?\d){12,}(?!\d)|(?<![\d.])\d{4}\.\d{4}\.\d{4}\.\d{4}(?!\d|\.\d)", re.ASCII)
_GROUP = re.compile(r"\d+", re.ASCII)
#: Sizes of the groups in which cards are written, besides a single one; of two forms at a place the one of fewer groups wins.
CARD_FORMS = {
    (4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 3, 3, 3), (4, 5, 6), (4, 4, 4, 2), (4, 4, 4, 3), (4, 4, 5), (8, 8), (6, 10), (6, 13),
    (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3),
}
#: Calling codes of two digits (fixed values); those that begin with 1 or 7 have one digit, all others three.
TWO_DIGIT_CODES = {
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54",
    "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
}
_EMAIL = re.compile(r"(?<![A-Za-z0-9_.+-])([A-Za-z0-9_.+-]+)@((?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})(?![A-Za-z0-9])")
_LAST = re.compile(r"\d")


class Feistel:
    """A keyed permutation of 0 to ``size`` - 1: balanced rounds on bits, walked back into the domain."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.base = hashlib.blake2b(tweak.encode(), key=hashlib.sha256(key).digest(), digest_size=(self.half + 7) // 8 if self.half <= 512 else 64)

    def _round(self, k: int, value: int) -> int:
        state = self.base.copy()
        state.update(bytes((k,)) + value.to_bytes((self.half + 7) // 8))
        out = state.digest()
        while 8 * len(out) < self.half:  # a format longer than one digest
            state.update(b"+")
            out += state.digest()
        return int.from_bytes(out) & self.mask

    def _once(self, x: int, rounds) -> int:
        left, right = x >> self.half, x & self.mask
        for k in rounds:
            if k >= 0:
                left, right = right, left ^ self._round(k, right)
            else:
                left, right = right ^ self._round(~k, left), left
        return left << self.half | right

    def _walk(self, x: int, rounds) -> int:
        x = self._once(x, rounds)
        while x >= self.size:
            x = self._once(x, rounds)
        return x

    def to(self, x: int) -> int:
        return self._walk(x, range(ROUNDS))

    def back(self, x: int) -> int:
        return self._walk(x, [~k for k in reversed(range(ROUNDS))])


def luhn_digit(payload: str) -> str:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1


class CardRun:
    """The cards among digit groups that stand together: single groups, then ``CARD_FORMS``, then other groups of 13 to 19 digits.

    A number is replaced only by one with which the search finds the same cards
    again, so that pseudonyms can be turned back.
    """

    def __init__(self, groups: list[str]):
        self.groups, self.sizes = groups, [len(g) for g in groups]
        self.single = [is_card(g) for g in groups]
        self.forms = [(i, i + 1, 0, None) for i, one in enumerate(self.single) if one]
        n, i, gap = len(groups), 0, 0
        while i < n:
            j = i + 1 if self.single[i] else next((e for e in self._ends(i) if self._card(i, e)), 0)
            if j and not self.single[i]:
                self.forms.append((i, j, gap, [(i, e) for e in self._ends(i) if e < j]))
            gap, i = j or gap, j or i + 1
        self.others = []
        taken = sorted((i, j) for i, j, _, _ in self.forms)
        for a, b in zip([0] + [j for _, j in taken], [i for i, _ in taken] + [n]):
            self._search_others(a, b)

    def _card(self, i: int, j: int) -> bool:
        return is_card("".join(self.groups[i:j]))

    def _ends(self, i: int) -> list[int]:
        """Ends of the forms that begin at a group, without those that hold a card of one group."""
        return [i + k for k in (2, 3, 4, 5) if tuple(self.sizes[i : i + k]) in CARD_FORMS and not any(self.single[i : i + k])]

    def _search_others(self, a: int, b: int) -> None:
        i = a
        while i < b:
            j, digits = i, 0
            while j < b and digits + self.sizes[j] <= 19:
                digits += self.sizes[j]
                j += 1
            if digits < 13:
                i += 1
                continue
            parts = [(x, y) for x in range(i, j) for y in range(j, x, -1)]
            for k, (x, y) in enumerate(parts):
                if self._card(x, y):
                    self.others.append((x, y, a, parts[:k]))
                    break
            i = j

    def _same(self, i: int, j: int, gap: int, before: list[tuple[int, int]], last: int) -> bool:
        """Whether nothing that comes before the card of groups ``i`` to ``j`` in the search is a card."""
        if any(is_card(g) for g in self.groups[i:j]) and j - i > 1 or any(self._card(x, y) for x, y in before):
            return False
        return not any(self._card(s, e) for s in range(max(gap, i - 4), last) for e in self._ends(s) if e > i)

    def replace(self, other, back: bool) -> int:
        """Puts ``other`` of each card in its place; the number of cards."""
        cards = [(*c, c[0]) for c in self.forms] + [(*c, c[1]) for c in self.others]
        for i, j, gap, before, last in reversed(cards) if back else cards:
            while True:
                digits, at = other("".join(self.groups[i:j])), 0
                for k in range(i, j):
                    self.groups[k] = digits[at : at + self.sizes[k]]
                    at += self.sizes[k]
                if before is None or self._same(i, j, gap, before, last):
                    break
        return len(cards)


def _filled(value: str, digits: str) -> str:
    """``value`` with its digits replaced in order."""
    it = iter(digits)
    return _LAST.sub(lambda _: next(it), value)


class Pseudonyms:
    """Replaces values of each kind by those of the same format; ``back`` undoes it with the same key."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.way = key, "back" if back else "to"
        self.known: dict[tuple[str, int], Feistel] = {}
        self.seen: dict[tuple[str, str], str | None] = {}

    def _permuted(self, tweak: str, size: int, x: int) -> int:
        if (tweak, size) not in self.known:
            self.known[tweak, size] = Feistel(self.key, tweak, size)
        return getattr(self.known[tweak, size], self.way)(x)

    def _digits(self, tweak: str, digits: str) -> str:
        n = len(digits)
        return str(self._permuted(f"{tweak}{n}", 10**n, int(digits))).zfill(n)

    def card(self, digits: str) -> str | None:
        if not is_card(digits):
            return None
        payload = self._digits("card", digits[:-1])
        if len(set(payload + luhn_digit(payload))) == 1:  # not a number that would be taken: walk on
            payload = self._digits("card", payload)
        return payload + luhn_digit(payload)

    def phone(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not 9 <= len(digits) <= 15:
            return None
        country = digits[: 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3]
        return _filled(value, country + self._digits("phone" + country, digits[len(country) :]))

    def ip(self, value: str) -> str | None:
        parts = value.split(".")
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None
        x = self._permuted("ip", 1 << 32, int.from_bytes(bytes(map(int, parts))))
        return ".".join(map(str, x.to_bytes(4)))

    def date(self, value: str) -> str | None:
        """Days are read first, months first only with strokes where that is the one way to read the date, which then holds for the pseudonym."""
        mark = "-" if "-" in value else "/" if "/" in value else "."
        parts = [int(p) for p in value.split(mark)]
        first = len(value.split(mark)[0]) == 4
        year, month, day = parts if first else parts[::-1]
        swapped = mark == "/" and not first and month > 12
        if swapped:
            month, day = day, month
        try:
            at = datetime.date(year, month, day).toordinal() - FIRST_DAY
        except ValueError:
            return None
        size = LAST_DAY - FIRST_DAY + 1
        if not 0 <= at < size:
            return None
        at = self._permuted("date", size, at)
        while swapped and datetime.date.fromordinal(FIRST_DAY + at).day <= 12:
            at = self._permuted("date", size, at)
        other = datetime.date.fromordinal(FIRST_DAY + at)
        if first:
            return f"{other.year}{mark}{other.month:02d}{mark}{other.day:02d}"
        month, day = (other.day, other.month) if swapped else (other.month, other.day)
        return f"{day:02d}{mark}{month:02d}{mark}{other.year}"

    def email(self, value: str) -> str:
        """Letters and digits before the @ are permuted by place and kind; the domain stays."""
        local, _, domain = value.partition("@")
        x, size, radices = 0, 1, []
        for c in local:
            first, radix = ("0", 10) if c.isdigit() else ("a", 26) if c.islower() else ("A", 26) if c.isupper() else (c, 1)
            radices.append((first, radix))
            x, size = x * radix + ord(c) - ord(first), size * radix
        x = self._permuted("email" + "".join(f for f, _ in radices) + "@" + domain.lower(), size, x)
        out = []
        for first, radix in reversed(radices):
            x, d = divmod(x, radix)
            out.append(chr(ord(first) + d))
        return "".join(reversed(out)) + "@" + domain

    def of(self, kind: str, value: str) -> str | None:
        """The pseudonym of a value, None if it is not valid; the latest values are remembered."""
        if (kind, value) not in self.seen:
            if len(self.seen) >= 100_000:
                self.seen.clear()
            self.seen[kind, value] = getattr(self, kind)(value)
        return self.seen[kind, value]

    def text(self, text: str) -> tuple[str, list[int]]:
        """A text with all values replaced, and how many of each of ``KINDS``."""
        counts = dict.fromkeys(KINDS, 0)

        def put(kind: str, value: str) -> str:
            other = self.of(kind, value)
            counts[kind] += other is not None
            return value if other is None else other

        def put_cards(run: re.Match) -> str:
            found = CardRun(_GROUP.findall(run[0]))
            n = found.replace(lambda digits: self.of("card", digits), self.way == "back")
            counts["card"] += n
            return _filled(run[0], "".join(found.groups)) if n else run[0]

        def put_numbers(part: str) -> str:
            """Cards are sought between the other numbers, so that these do not join them."""
            out, last = [], 0
            for m in _NUMBERS.finditer(part):
                other = put(m.lastgroup, m[0])
                if self.of(m.lastgroup, m[0]) is not None:
                    out += [_RUN.sub(put_cards, part[last : m.start()]), other]
                    last = m.end()
            return "".join(out) + _RUN.sub(put_cards, part[last:])

        # mail addresses first take their place, so that digits in them are not numbers
        parts, last = [], 0
        if "@" in text:
            for m in _EMAIL.finditer(text):
                parts += [text[last : m.start()], put("email", m[0])]
                last = m.end()
        parts.append(text[last:])
        for k in range(0, len(parts), 2):
            parts[k] = put_numbers(parts[k])
        return "".join(parts), [counts[k] for k in KINDS]


def _replaced(key: bytes, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, back)
        for batch in batches:
            texts, counts = [], [[] for _ in KINDS]
            for value in batch.column(1):
                text, found = (None, [0] * len(KINDS)) if not value.is_valid else names.text(value.as_py())
                texts.append(text)
                for c, n in zip(counts, found):
                    c.append(n)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{k}" for k in KINDS), "text"])

    return run


def pseudonymised(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """doc_id, n_card, n_phone, n_ip, n_date, n_email and text of every row of ``docs``, with pseudonyms in the text.

    A card beside other digit groups is found if it is one group or has one of
    ``CARD_FORMS``; in other forms among groups of 19 digits at most, wherever
    in them it begins and ends. Equal phone numbers are linked however their
    digits are grouped, as the calling code follows from the digits. Where a
    pseudonym would make another card of its neighbours, the next one is taken.
    Dates are year-month-day, day.month.year, day/month/year, month/day/year where
    only that is valid, year/month/day and year.month.day; those with dots or strokes
    get two digits for day and month. Not sought: years of two digits, names of
    months, day-month-year with hyphens, phone numbers without a leading + or with
    the trunk 0 in brackets, cards with dots but in four fours or with two
    blanks between groups, IBAN, social security numbers, IPv6. A date
    valid only month first gets another such date, so it can differ from the
    pseudonym of the same day in other forms. What does not validate (a wrong check digit, a 30 February, 300.1.1.1) stays. A null text
    stays null, an empty one empty; repeated rows and null ids are treated like any
    other. ``back`` turns pseudonyms into the values again. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", text string"
    return rows.mapInArrow(_replaced(key, back), kind)
