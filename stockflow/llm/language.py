"""Language of documents by bit-sliced Bloom filters over character n-grams.

Learning counts the n-grams of every labelled training text, per language. An n-gram
belongs to a language if it makes up at least `MIN_RATE` of that language's n-grams and at
least `MIN_SHARE` of its highest rate in any language. All languages share one Bloom filter
whose slots hold a bit per language: AND-ing the slots of an n-gram gives the bitmask of
all languages that contain it. A text is given to the language with the most contained
n-grams, after taking off what the filter returns by chance.

The filter has a bounded size: a language has at most 1 / MIN_RATE n-grams per length,
however large the corpus. Texts are worked on whole.

Defined cases: null text and text without a letter get `und` with score 0; a text with
letters of which no n-gram is known gets the language with the most training n-grams, score
0; without any training row all texts get `und`. Rows with null lang are not learned from.
Rows with equal or null ids keep one row each; a null id counts as an empty one for the fold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm import textbytes as tb
from stockflow.llm.rows import ROW, packed, unpacked
from stockflow.session import written

LENGTHS = (3, 4)
MIN_RATE = 1e-5
MIN_SHARE = 0.2
PROBES = 2
SLOTS_PER_GRAM = 16
UNKNOWN = "und"
SLICE_BYTES = 1 << 20  # an n-gram takes many times the bytes of its letter
PENDING = 4 << 20  # n-grams a training task holds before it hands on their counts
SPACE = 0x20


def _letters() -> np.ndarray:
    """For every code point: itself if it is a letter, else a space."""
    table = np.full(0x110000, SPACE, np.uint32)
    points = np.array([k for k in range(0x110000) if chr(k).isalpha()], np.uint32)
    table[points] = points
    return table


def grams_of(texts: list[str | None], letters: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """((n-grams, n-grams per text) for each length, whether each text has a letter).

    Texts are lower-cased; what is not a letter is one space between words and at both ends.
    """
    coded = [b" \0\0\0" + (t or "").lower().encode("utf-32-le") + b" \0\0\0" for t in texts]
    sizes = np.array([len(c) // 4 for c in coded], np.int64)
    points = letters[np.frombuffer(b"".join(coded), np.uint32)]
    owner_end = np.cumsum(sizes)
    first = np.zeros(len(points), bool)
    first[owner_end - sizes] = True
    blank = points == SPACE
    keep = first | ~blank
    keep[1:] |= ~blank[:-1]
    kept = np.flatnonzero(keep)
    points = points[kept].astype(np.uint64)
    bounds = np.searchsorted(kept, np.concatenate([[0], owner_end]))
    number = np.diff(bounds)
    has_letter = number > 2
    found = []
    packed = points
    for length in range(2, max(LENGTHS) + 1):
        reach = length - 1
        # three code points fit into 63 bits; longer n-grams are hashed on
        step = packed[:-1] if len(packed) else packed
        packed = step * np.uint64(1 << 21) + points[reach:] if length < 4 else tb.mixed(step) + points[reach:] * tb.BASE
        if length in LENGTHS:
            count = np.where(has_letter, np.maximum(number - reach, 0), 0)
            start = np.repeat(bounds[:-1], count) + _ranges(count)
            found.append((packed[start] * np.uint64(2) + np.uint64(length % 2), count))
    return found, has_letter


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. c-1 for each count c, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _counting(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, n-gram) of the training rows of a task."""
    letters = _letters()
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([g for g, _ in held[lang]])
        times = np.concatenate([n for _, n in held[lang]])
        values, place = np.unique(grams, return_inverse=True)
        return values, np.bincount(place, times, len(values)).astype(np.int64)

    def rows() -> Iterator[pa.RecordBatch]:
        for lang in held:
            grams, times = merged(lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(times)],
                ["lang", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        for a, b in tb.slices(batch.column("text"), SLICE_BYTES):
            part = batch.slice(a, b - a)
            found, _ = grams_of(part.column("text").to_pylist(), letters)
            names, number = np.unique(np.array(part.column("lang").to_pylist(), str), return_inverse=True)
            for grams, counts in found:
                owner = np.repeat(number, counts)
                for k, lang in enumerate(names.tolist()):
                    values, times = np.unique(grams[owner == k], return_counts=True)
                    held.setdefault(lang, []).append((values, times))
            for lang in names.tolist():
                if len(held[lang]) > 8:
                    held[lang] = [merged(lang)]
            if sum(len(g) for own in held.values() for g, _ in own) > PENDING:
                yield from rows()
    yield from rows()


@dataclass(frozen=True)
class LanguageFilters:
    """One Bloom filter for all languages: `slots` has a bit per language in each slot."""

    languages: list[str]
    slots: np.ndarray  # (slots, words of 64 languages)
    bits: int
    chance: np.ndarray  # per language: how often an n-gram it lacks seems contained
    default: int

    def probe(self, grams: np.ndarray) -> np.ndarray:
        """Bitmask of the languages that contain each n-gram."""
        found = self.slots[_slot(grams, 0, self.bits)]
        for k in range(1, PROBES):
            found = found & self.slots[_slot(grams, k, self.bits)]
        return found

    def classify(self, texts: list[str | None], letters: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, share of known n-grams) of each text."""
        found, has_letter = grams_of(texts, letters)
        share = np.zeros((len(texts), len(self.languages)))
        for grams, counts in found:
            masks = self.probe(grams)
            ends = np.concatenate([[0], np.cumsum(counts)])
            for k in range(len(self.languages)):
                bit = (masks[:, k // 64] >> masks.dtype.type(k % 64)) & masks.dtype.type(1)
                hits = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)])
                share[:, k] += np.diff(hits[ends])
        share /= np.maximum(sum(counts for _, counts in found), 1)[:, None]
        share = np.clip((share - self.chance) / (1 - self.chance), 0, 1)
        best = np.argmax(share, axis=1) if len(self.languages) else np.zeros(len(texts), np.int64)
        total = share.sum(axis=1)
        best = np.where(total > 0, best, self.default)
        names = [self.languages[k] if ok and self.languages else UNKNOWN for k, ok in zip(best, has_letter)]
        top = share[np.arange(len(texts)), best] if len(self.languages) else total
        score = np.where(has_letter & (total > 0), top / np.where(total > 0, total, 1), 0.0)
        return names, score, np.where(has_letter, top, 0.0)


def _slot(grams: np.ndarray, probe: int, bits: int) -> np.ndarray:
    salt = np.uint64((probe + 1) * int(tb.MIX) % (1 << 64))
    return tb.mixed(grams + salt) >> np.uint64(64 - bits)


def learn(training: DataFrame) -> LanguageFilters:
    """Filters from the columns text and lang of the training rows."""
    rows = training.select("lang", "text").dropna()
    counted = rows.mapInArrow(_counting, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counted, "language-counts")
    # one length weighs as the other: both have about one n-gram per letter
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    per_gram = (
        counts.join(totals, "lang")
        .withColumn("rate", F.col("n") / F.col("total"))
        .groupBy("gram")
        .agg(F.max("rate").alias("best"), F.collect_list(F.struct("lang", "rate")).alias("langs"))
        .filter(F.col("best") >= MIN_RATE)
        .select(
            "gram",
            F.expr(
                f"transform(filter(langs, x -> x.rate >= greatest({MIN_RATE}, {MIN_SHARE} * best)), x -> x.lang)"
            ).alias("langs"),
        )
    )
    # at most len(LENGTHS) / MIN_RATE n-grams per language reach this point
    kept = per_gram.orderBy("gram").toArrow()
    learned = sorted((r["lang"], r["total"]) for r in totals.collect())
    languages = [lang for lang, _ in learned]
    return _filled(kept, languages, int(np.argmax([n for _, n in learned])) if learned else 0)


def _filled(kept: pa.Table, languages: list[str], default: int) -> LanguageFilters:
    bits = max(12, int(np.ceil(np.log2(max(1, SLOTS_PER_GRAM * kept.num_rows)))))
    words = max(1, -(-len(languages) // 64))
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    slots = np.zeros((1 << bits, words), kind)
    grams = kept.column("gram").to_numpy().view(np.uint64)
    lists = kept.column("langs").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    index = {lang: k for k, lang in enumerate(languages)}
    names = np.array([index[x] for own in lists.to_pylist() for x in own], np.int64)
    owner = np.repeat(np.arange(len(grams)), [len(own) for own in lists.to_pylist()])
    for k in range(PROBES):
        at = _slot(grams, k, bits)[owner]
        np.bitwise_or.at(slots, (at, names // 64), np.left_shift(np.ones(len(names), kind), (names % 64).astype(kind)))
    filled = np.array([((slots[:, k // 64] >> kind(k % 64)) & kind(1)).mean() for k in range(len(languages))])
    return LanguageFilters(languages, slots, bits, filled**PROBES, default)


def _predicting(filters: LanguageFilters, keep: list[str]) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in batches:
            for a, b in tb.slices(batch.column("_text"), SLICE_BYTES):
                part = batch.slice(a, b - a)
                names, score, known = filters.classify(part.column("_text").to_pylist(), letters)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(names, pa.string()), pa.array(score), pa.array(known)],
                    [*keep, "_lang", "_score", "_known"],
                )

    return run


def predict(documents: DataFrame, filters: LanguageFilters, keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns with lang_pred, score (0 to 1) and known (share of known n-grams)."""
    keep = documents.columns if keep is None else keep
    # a text that is kept moves once
    inner = ["_text" if c == "text" else f"_keep{i}" for i, c in enumerate(keep)]
    moved = {"_text": "text", **dict(zip(inner, keep))}
    source = documents.select(*[F.col(c).alias(x) for x, c in moved.items()])
    fields = ", ".join(f"{x} {source.schema[x].dataType.simpleString()}" for x in inner)
    schema = f"{fields}{', ' if inner else ''}_lang string, _score double, _known double"
    out = source.mapInArrow(_predicting(filters, inner), schema)
    return out.select(
        *[F.col(x).alias(c) for x, c in zip(inner, keep)],
        F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_known").alias("known"),
    )


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


# a text of a learned language has most of its n-grams in that language's filter, one of
# another language few: on sf0.1 (10,000 documents) held-out texts of learned languages have
# 0.40 at least, while 125 of those whose language was left out of learning have 0.4 or more
LEAST_KNOWN = 0.4


def accepted(documents: DataFrame, filters: LanguageFilters) -> DataFrame:
    """The documents in one of the learned languages."""
    found = predict(packed(documents), filters, [ROW, "text"])
    return unpacked(found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("known") >= LEAST_KNOWN)), documents.columns)
