"""Benchmark passages in documents, found by Wu-Manber multi-pattern search.

Documents and benchmark items are reduced to their words (A-Z lower-cased, one space
between words). A window of an item is `WINDOW` consecutive words, or the whole item when
it has fewer. All windows are searched at once:

* patterns of similar length share a shift table over hashed blocks of text; where a block
  stands in no pattern, the search jumps ahead by nearly a whole pattern,
* where the shift is zero, a hash of the last and the first block picks the few patterns
  that may end here,
* those are compared byte by byte, so no hash decides an occurrence.

The search moves many cursors through a slice of documents in step, so a jump is one
vector operation. The benchmark is cut into blocks of a bounded size; each block is one
pass over the documents, chained in the same task, without a shuffle. There is no limit on
the number of items, windows or occurrences.

Defined cases: null text has no words; an item with null text or no words has no window; an
item with null id is ignored; repeated items count once by id; documents with equal or null
ids keep one row each; other columns of either table play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.llm import textbytes as tb
from stockflow.llm.rows import ROW, packed, unpacked

WINDOW = 10
BLOCK_BYTES = 8 << 20  # of benchmark text that one pass searches for
BLOCK = 8  # longest block of the shift tables, in bytes
LANE = 2048  # bytes of text that one cursor walks through

# fixed values: all ASCII but digits and letters parts words
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]

HITS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))


def word_stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offset of each document, words of each document): " w1 w2 ... \\n" per document."""
    raw, bounds = tb.text_bytes(column, b" \n")
    table = np.arange(256, dtype=np.uint8)
    table[SEPARATORS] = 0x20
    table = table[tb.lower_table()]
    ends = bounds[1:] - 1
    raw = table[raw]
    raw[ends] = 0x0A
    # one space where words part, one before the first word
    blank = raw == 0x20
    keep = np.ones(len(raw), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    if len(raw):
        first_is_word = np.zeros(len(raw) + 1, bool)
        first_is_word[bounds[:-1]] = True
        lead = np.flatnonzero(first_is_word[:-1] & ~blank & (raw != 0x0A))
    else:
        lead = np.zeros(0, np.int64)
    kept = np.flatnonzero(keep)
    stream = np.insert(raw[kept], np.searchsorted(kept, lead), np.uint8(0x20))
    ends_at = np.flatnonzero(stream == 0x0A)
    offsets = np.concatenate([[0], ends_at + 1])
    spaces = tb.per_document(np.flatnonzero(stream == 0x20), offsets)
    return stream, offsets, np.maximum(spaces - 1, 0)


def windows_of(texts: list[str], ids: list[str], window: int = WINDOW) -> tuple[list[bytes], list[set[str]]]:
    """The distinct windows of the items and, for each, the ids of its items."""
    stream, offsets, _ = word_stream(pa.array(texts, pa.string()))
    found: dict[bytes, set[str]] = {}
    for i, item in enumerate(ids):
        words = stream[offsets[i] : offsets[i + 1] - 1].tobytes().split()
        for k in range(max(len(words) - window, 0) + 1 if words else 0):
            found.setdefault(b" %b " % b" ".join(words[k : k + window]), set()).add(item)
    return list(found), list(found.values())


def _eight(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number; `buffer` ends in eight spare bytes."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))


class PatternGroup:
    """Shift and bucket tables of patterns whose lengths lie within a factor of two."""

    def __init__(self, patterns: list[bytes], numbers: np.ndarray):
        lengths = np.array([len(p) for p in patterns], np.int64)
        self.short = int(lengths.min())
        self.block = min(self.short, BLOCK)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        packed = np.frombuffer(b"".join(patterns) + b"\0" * 8, np.uint8).copy()
        starts = np.cumsum(lengths) - lengths
        self.bits = int(np.clip(np.ceil(np.log2(8.0 * len(patterns) * self.short)), 12, 22))
        self.shift = np.full(1 << self.bits, self.short - self.block + 1, np.int32)
        view = _eight(packed)
        for end in range(self.block, self.short + 1):
            at = self.slot(view[starts + end - self.block] & self.mask)
            np.minimum.at(self.shift, at, np.int32(self.short - end))
        bucket = self.bucket(view, starts)
        order = np.argsort(bucket, kind="stable")
        self.buckets, self.starts, self.lengths = bucket[order], starts[order], lengths[order]
        self.numbers, self.packed = numbers[order], packed

    def slot(self, block: np.ndarray) -> np.ndarray:
        return (block * tb.BASE) >> np.uint64(64 - self.bits)

    def bucket(self, view: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hash of the first and the last block of the common length."""
        first = view[starts] & self.mask
        last = view[starts + self.short - self.block] & self.mask
        return tb.mixed(first * tb.MIX + last)

    def candidates(self, view: np.ndarray, n: int) -> np.ndarray:
        """Starts of the positions that the shift table cannot rule out."""
        reach = self.short - 1
        begin = np.arange(0, n, LANE, dtype=np.int64)
        stop = np.minimum(begin + LANE, n)
        at = np.maximum(begin, reach)
        live = at < stop
        at, stop = at[live], stop[live]
        back = self.block - 1
        found = []
        while len(at):
            step = self.shift[self.slot(view[at - back] & self.mask)]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
        return np.concatenate(found) - reach if found else np.zeros(0, np.int64)

    def search(self, view: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, pattern number) of every occurrence in the first n bytes."""
        at = self.candidates(view, n)
        key = self.bucket(view, at)
        low = np.searchsorted(self.buckets, key, "left")
        high = np.searchsorted(self.buckets, key, "right")
        many = high - low
        starts, numbers = [], []
        # buckets hold few patterns; the loop over their members bounds the memory
        for k in range(int(many.max(initial=0))):
            some = many > k
            where, which = at[some], low[some] + k
            whole = where + self.lengths[which] <= n
            where, which = where[whole], which[whole]
            same = np.ones(len(where), bool)
            theirs = _eight(self.packed)
            for done in range(0, int(self.lengths[which].max(initial=0)), 8):
                left = np.clip(self.lengths[which] - done, 0, 8)
                mask = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (left * 8 % 64).astype(np.uint64)) - np.uint64(1))
                ours = view[np.minimum(where + done, n)]
                other = theirs[np.minimum(self.starts[which] + done, len(theirs) - 1)]
                same &= ((ours ^ other) & mask) == 0
            starts.append(where[same])
            numbers.append(self.numbers[which[same]])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(numbers)


class Matcher:
    """All windows of one block of the benchmark."""

    def __init__(self, texts: list[str], ids: list[str], window: int = WINDOW):
        patterns, items = windows_of(texts, ids, window)
        self.names = sorted({name for group in items for name in group})
        index = {name: k for k, name in enumerate(self.names)}
        self.items = [np.array(sorted(index[name] for name in group), np.int64) for group in items]
        self.words = np.array([p.count(b" ") - 1 for p in patterns], np.int64)
        classes: dict[int, list[int]] = {}
        for k, pattern in enumerate(patterns):
            classes.setdefault(len(pattern).bit_length(), []).append(k)
        self.groups = [PatternGroup([patterns[k] for k in own], np.array(own)) for own in classes.values()]

    def search(self, column: pa.Array):
        """(words per document, document / first word / words of each hit, sorted (document, item) pairs)."""
        stream, offsets, n_words = word_stream(column)
        n = len(stream)
        view = _eight(np.append(stream, np.zeros(8, np.uint8)))
        found = [group.search(view, n) for group in self.groups]
        at = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        which = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        document = np.searchsorted(offsets, at, "right") - 1
        spaces = np.flatnonzero(stream == 0x20)
        first = np.searchsorted(spaces, at) - np.searchsorted(spaces, offsets[document])
        distinct = np.unique(document * max(len(self.items), 1) + which)
        pairs = [
            (d, i)
            for key in distinct.tolist()
            for d, k in [divmod(key, max(len(self.items), 1))]
            for i in self.items[k].tolist()
        ]
        return n_words, document, first, self.words[which], sorted(set(pairs))


def _merged(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Intervals as disjoint ascending ones."""
    order = np.argsort(first, kind="stable")
    out: list[tuple[int, int]] = []
    for a, b in zip(first[order].tolist(), end[order].tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _searching(texts: list[str], ids: list[str], window: int, keep: list[str]) -> Callable:
    """The task of one pass; earlier passes' hits and items are carried along and merged."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(texts, ids, window)
        for batch in batches:
            for a, b in tb.slices(batch.column("_text")):
                part = batch.slice(a, b - a)
                n_words, document, first, words, pairs = matcher.search(part.column("_text"))
                before = part.column("_hits").to_pylist(), part.column("_items").to_pylist()
                hits = [[(h["first"], h["end"]) for h in x] for x in before[0]]
                items = [set(x) for x in before[1]]
                order = np.argsort(document, kind="stable")
                places = np.unique(document)
                for d, own in zip(places.tolist(), np.split(order, np.searchsorted(document[order], places[1:]))):
                    old = np.array(hits[d], np.int64).reshape(-1, 2)
                    hits[d] = _merged(
                        np.concatenate([old[:, 0], first[own]]), np.concatenate([old[:, 1], first[own] + words[own]])
                    )
                for d, i in pairs:
                    items[d].add(matcher.names[i])
                spans = pa.array([[{"first": x, "end": y} for x, y in h] for h in hits], part.schema.field("_hits").type)
                arrays = [part.column(c) for c in keep]
                arrays += [
                    part.column("_text"),
                    pa.array(n_words, pa.int64()),
                    spans,
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, [*keep, "_text", "_words", "_hits", "_items"])

    return run


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list[str], list[str]]]:
    """(texts, ids) of the benchmark in blocks of about `block_bytes`, one at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("words")).dropna()
    total = items.agg(F.sum(F.octet_length("words")).alias("bytes")).first()["bytes"] or 0
    blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    for k in range(blocks):
        rows = items.filter(block == k).collect()
        yield [r["words"] for r in rows], [r["item"] for r in rows]


def find_passages(
    documents: DataFrame,
    benchmark: DataFrame,
    keep: list[str] | None = None,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The `keep` columns of every document with what was found in it.

    n_words: words of the text; hits: disjoint ascending [first, end) word ranges inside any
    occurrence of a window; items: ids, as strings, of the items with an occurring window.
    """
    keep = documents.columns if keep is None else keep
    state = documents.select(
        *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)],
        F.coalesce("text", F.lit("")).alias("_text"),
        F.lit(0).cast("long").alias("_words"),
        F.array().cast(HITS).alias("_hits"),
        F.array().cast("array<string>").alias("_items"),
    )
    inner = [f"_keep{i}" for i in range(len(keep))]
    for texts, ids in benchmark_blocks(benchmark, block_bytes):
        state = state.mapInArrow(_searching(texts, ids, window, inner), state.schema)
    return state.select(
        *[F.col(x).alias(c) for x, c in zip(inner, keep)],
        F.col("_words").alias("n_words"),
        F.col("_hits").alias("hits"),
        F.col("_items").alias("items"),
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window of any item occurs."""
    found = find_passages(packed(documents), benchmark, [ROW, "text"])
    return unpacked(found.filter(F.size("hits") == 0), documents.columns)
