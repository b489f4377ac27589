"""Personal data replaced by format-preserving Feistel pseudonyms.

Recognised values: e-mail addresses, telephone numbers, payment card numbers, national
identity numbers (000-00-0000 shape), IPv4 addresses, calendar dates, and keys or tokens in
hexadecimal. A value is validated before it is touched: a card number by its check digit, a
national number by the areas, groups and serials that are given out, fields of an address or
date by range. Card numbers are written in one run of 13 to 19 digits, as 4-4-4-4 or as 4-6-5;
which digits belong together is read from the left and by the writing alone, so that a
pseudonym is found again where the value was. Dates may have one-digit days and months, and
year-first ones may go on as a time stamp (2024-03-05T10:00), whose time stays.

The variable part of a value is a number below the size of its format (digits of a card,
days of a calendar span, addresses, letters and digits of a name). A keyed Feistel network
permutes that range; cycle walking keeps it inside. So equal values stay equal in all
documents, different ones stay different, separators and lengths stay as they were, a card
gets another valid check digit, a national number another that could be given out, and a date
becomes another date of the same widths. Dates with a one-digit field are permuted among
themselves, by widths, and so are linked with dates of the same writing only. With the key the
permutation can be undone (`unmasked`).

The work is one pass over the rows, in batches, without a shuffle; texts are read whole.

Defined cases: null text stays null, empty text stays empty; a text without such values is
returned as it is; rows with equal or null ids keep one row each; other columns pass through.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import textbytes as tb
from stockflow.llm.rows import packed, unpacked

KEY = "an example key; production passes its own"
ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
LAST_DAY = datetime.date(2099, 12, 31).toordinal()

# national numbers: areas 001 to 899 but one, groups 01 to 99, serials 0001 to 9999
NO_AREA = 666
AREAS, GROUPS, SERIALS = 898, 99, 9999

LOWER = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"


class Feistel:
    """Keyed permutations of 0 .. size-1, one for each size and purpose."""

    def __init__(self, key: str):
        self.key = key.encode()

    def _round(self, purpose: str, turn: int, value: int, below: int) -> int:
        message = f"{purpose}:{turn}:{value}".encode()
        width = (below.bit_length() + 71) // 8
        digest = hmac.new(self.key, message, hashlib.sha512).digest()
        while len(digest) < width:
            digest += hmac.new(self.key, digest, hashlib.sha512).digest()
        return int.from_bytes(digest[:width], "big") % below

    def _once(self, value: int, left: int, right: int, purpose: str, back: bool) -> int:
        """A permutation of left * right numbers; the halves take turns to be changed."""
        a, b = divmod(value, right)
        for turn in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            sign = -1 if back else 1
            if turn % 2:
                b = (b + sign * self._round(purpose, turn, a, right)) % right
            else:
                a = (a + sign * self._round(purpose, turn, b, left)) % left
        return a * right + b

    def permuted(self, value: int, size: int, purpose: str, back: bool = False) -> int:
        if size < 2:
            return value
        right = max(2, int(size**0.5)) if size < 1 << 52 else 1 << (size.bit_length() // 2)
        left = -(-size // right)
        purpose = f"{purpose}:{size}"
        value = self._once(value, left, right, purpose, back)
        while value >= size:  # the walk stays on the cycle of a number inside
            value = self._once(value, left, right, purpose, back)
        return value


def _as_number(text: str, alphabet: str) -> int:
    value = 0
    for c in text:
        value = value * len(alphabet) + alphabet.index(c)
    return value


def _as_text(value: int, length: int, alphabet: str) -> str:
    out = []
    for _ in range(length):
        value, k = divmod(value, len(alphabet))
        out.append(alphabet[k])
    return "".join(reversed(out))


class Masker:
    """Pseudonyms of values, and the values of pseudonyms with `back`."""

    def __init__(self, key: str = KEY, back: bool = False):
        self.feistel = Feistel(key)
        self.back = back
        self.mask = lru_cache(1 << 14)(self._mask)

    def _permuted(self, value: int, size: int, purpose: str) -> int:
        return self.feistel.permuted(value, size, purpose, self.back)

    def _run(self, text: str, alphabet: str, purpose: str) -> str:
        """A run of characters of one alphabet, as a whole."""
        size = len(alphabet) ** len(text)
        return _as_text(self._permuted(_as_number(text, alphabet), size, purpose), len(text), alphabet)

    def _digits_in(self, text: str, purpose: str, skip: int = 0) -> str:
        """All digits of `text` but the first `skip` as one number, other characters kept."""
        places = [i for i, c in enumerate(text) if c in DIGITS][skip:]
        new = iter(self._run("".join(text[i] for i in places), DIGITS, purpose))
        chars = list(text)
        for i in places:
            chars[i] = next(new)
        return "".join(chars)

    def email(self, text: str) -> str:
        """The part before the @: letters and digits permuted per run of their alphabet."""
        local, _, domain = text.rpartition("@")
        return self._pieces(local, "email:" + domain.lower()) + "@" + domain

    def _pieces(self, text: str, purpose: str) -> str:
        kinds = ((LOWER, "l"), (LOWER.upper(), "u"), (DIGITS, "d"))
        out = text
        for alphabet, kind in kinds:
            places = [i for i, c in enumerate(text) if c in alphabet]
            if places:
                shape = re.sub("[a-z]", "l", re.sub("[A-Z]", "u", re.sub("[0-9]", "d", text)))
                new = iter(self._run("".join(text[i] for i in places), alphabet, f"{purpose}:{kind}:{shape}"))
                chars = list(out)
                for i in places:
                    chars[i] = next(new)
                out = "".join(chars)
        return out

    def phone(self, text: str) -> str:
        """Digits behind the country code as one number."""
        code = len(re.match(r"\+?(\d*)", text)[1]) if text.startswith("+") else 0
        return self._digits_in(text, "phone", code)

    def card(self, text: str) -> str:
        """All digits but the check digit, which is set so that it is as right as it was."""
        digits = [c for c in text if c in DIGITS]
        error = (int(digits[-1]) - check_digit(digits[:-1])) % 10
        new = list(self._run("".join(digits[:-1]), DIGITS, "card"))
        new.append(str((check_digit(new) + error) % 10))
        give = iter(new)
        return "".join(next(give) if c in DIGITS else c for c in text)

    def national(self, text: str) -> str:
        """Area, group and serial as one number among those that can be given out."""
        area, group, serial = (int(x) for x in text.split("-"))
        rank = area - 1 - (area > NO_AREA)
        value = (rank * GROUPS + group - 1) * SERIALS + serial - 1
        rest, serial = divmod(self._permuted(value, AREAS * GROUPS * SERIALS, "national"), SERIALS)
        rank, group = divmod(rest, GROUPS)
        area = rank + 1 + (rank + 1 >= NO_AREA)
        return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"

    def address(self, text: str) -> str:
        fields = [int(x) for x in text.split(".")]
        value = ((fields[0] * 256 + fields[1]) * 256 + fields[2]) * 256 + fields[3]
        value = self._permuted(value, 1 << 32, "ipv4")
        return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))

    def secret(self, text: str) -> str:
        letters = "abcdef" if text == text.lower() else "ABCDEF"
        return self._run(text, DIGITS + letters, "secret" + letters)

    def date(self, text: str) -> str:
        """A day of the years 1900 to 2099, written as it was."""
        day, write, days = read_date(text)
        new = self._permuted(bisect_left(days, day.toordinal()), len(days), "date")
        return write(datetime.date.fromordinal(days[new]))

    def _mask(self, kind: str, text: str) -> str:
        return getattr(self, kind)(text)

    def text(self, text: str, found: list[tuple[int, int, str]]) -> str:
        parts, last = [], 0
        for start, end, kind in found:
            parts += [text[last:start], self.mask(kind, text[start:end])]
            last = end
        return "".join([*parts, text[last:]])


def check_digit(digits: list[str]) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 if k % 2 else 2)
        total += n - 9 if n > 9 else n
    return -total % 10


@lru_cache
def _days(month_digits: int, day_digits: int) -> Sequence[int]:
    """The days, ascending, that can be written with that many digits (two: with leading zeros)."""
    every = range(FIRST_DAY, LAST_DAY + 1)
    if month_digits == day_digits == 2:
        return every
    dates = map(datetime.date.fromordinal, every)
    return [d.toordinal() for d in dates if d.month < 10**month_digits and d.day < 10**day_digits]


def read_date(text: str) -> tuple[datetime.date, Callable[[datetime.date], str], Sequence[int]] | None:
    """The day a text names, how to write another one in its place, and the days that can be
    written so; None if it is no day."""
    parts = re.split(r"[-/.]", text)
    sep = re.findall(r"[-/.]", text)
    year_first = len(parts[0]) == 4
    year, month, day = parts if year_first else parts[::-1]
    american = not year_first and sep[0] == "/"
    if american:
        month, day = day, month
    widths = len(month), len(day)
    try:
        date = datetime.date(int(year), int(month), int(day))
    except ValueError:
        return None
    if not FIRST_DAY <= date.toordinal() <= LAST_DAY:
        return None

    def write(new: datetime.date) -> str:
        fields = [f"{new.year:04d}", f"{new.month:0{widths[0]}d}", f"{new.day:0{widths[1]}d}"]
        if not year_first:
            fields = [fields[1], fields[2], fields[0]] if american else fields[::-1]
        return sep[0].join(fields)

    return date, write, _days(*widths)


def _card(text: str) -> bool:
    digits = [c for c in text if c in DIGITS]
    return int(digits[-1]) == check_digit(digits[:-1])


def _national(text: str) -> bool:
    area, group, serial = (int(x) for x in text.split("-"))
    return 0 < area < 900 and area != NO_AREA and group > 0 and serial > 0


def _address(text: str) -> bool:
    return all(len(x) < 4 and (x == "0" or x[0] != "0") and int(x) < 256 for x in text.split("."))


# what is looked for, in the order in which overlapping finds are preferred
KINDS: list[tuple[str, str, Callable[[str], object] | None]] = [
    ("email", r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", None),
    ("secret", r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])", lambda t: re.search("[A-Fa-f]", t)),
    ("address", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", _address),
    ("phone", r"(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)", None),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)", lambda t: 8 <= sum(c.isdigit() for c in t) <= 15),
    ("phone", r"(?<![\w(])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])", None),
    ("national", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _national),
    ("card", r"(?<![\w.-])(?:\d{13,19}|\d{4}(?P<a>[ -])\d{4}(?P=a)\d{4}(?P=a)\d{4}|\d{4}(?P<b>[ -])\d{6}(?P=b)\d{5})(?![\w-])", _card),
    ("date", r"(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}(?=T\d{2}(?:\D|\d{2}(?:\d{2})?\b))|(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\w/-]|\.\d))", read_date),
]
_PATTERNS = [
    (kind, re.compile(pattern, 0 if kind == "email" else re.ASCII), valid) for kind, pattern, valid in KINDS
]
_DIGIT_OR_AT = re.compile(r"[0-9@]|[A-F]{32}|[a-f]{32}")


def found_in(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the values in a text, ascending and disjoint."""
    if not _DIGIT_OR_AT.search(text):
        return []
    out: list[tuple[int, int, str]] = []
    for kind, pattern, valid in _PATTERNS:  # earlier kinds first
        if kind == "email" and "@" not in text:
            continue
        new = [(m.start(), m.end(), kind) for m in pattern.finditer(text) if valid is None or valid(m[0])]
        out = _with_room(out, new) if new else out
    return out


def _with_room(out: list[tuple[int, int, str]], new: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The ascending spans of `out`, and those of `new` that overlap none of them."""
    starts = [span[0] for span in out]
    fitting = []
    for span in new:
        k = bisect_left(starts, span[1])  # the last span that begins before this one ends
        if k == 0 or out[k - 1][1] <= span[0]:
            fitting.append(span)
    return sorted(out + fitting)


def _masking(key: str, back: bool, kept: list[str]) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masker = Masker(key, back)
        for batch in batches:
            for a, b in tb.slices(batch.column("_text")):
                part = batch.slice(a, b - a)
                counts, new = [], []
                for text in part.column("_text").to_pylist():
                    found = found_in(text) if text else []
                    counts.append(len(found))
                    new.append(masker.text(text, found) if found else text)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(new, pa.string()), pa.array(counts, pa.int64())],
                    [*kept, "_text", "_found"],
                )

    return run


def masked(documents: DataFrame, key: str = KEY, back: bool = False) -> DataFrame:
    """`documents` with pseudonyms in text, and n_found: the values that were replaced."""
    columns = documents.columns
    others = [c for c in columns if c != "text"]
    inner = {c: f"_keep{i}" for i, c in enumerate(others)}
    source = documents.select(*[F.col(c).alias(x) for c, x in inner.items()], F.col("text").alias("_text"))
    schema = ", ".join([f"{x} {source.schema[x].dataType.simpleString()}" for x in inner.values()] + ["_text string", "_found long"])
    out = source.mapInArrow(_masking(key, back, list(inner.values())), schema)
    names = [F.col("_text").alias("text") if c == "text" else F.col(inner[c]).alias(c) for c in columns]
    return out.select(*names, F.col("_found").alias("n_found"))


def unmasked(documents: DataFrame, key: str = KEY) -> DataFrame:
    """The documents before `masked` with the same key."""
    return masked(documents, key, True).drop("n_found")


def pseudonymised(documents: DataFrame, key: str = KEY) -> DataFrame:
    """The columns of `documents`, with pseudonyms in text. Lengths stay, but for IPv4 fields."""
    return unpacked(masked(packed(documents), key), documents.columns)
