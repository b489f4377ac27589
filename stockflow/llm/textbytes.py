"""Text columns of Arrow batches as byte arrays, for vectorised work inside tasks.

Every helper works on a slice of documents of a bounded number of bytes, so the memory of
a task follows the slice and not its partition; one document longer than the bound is a
slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

# fixed values: what counts as white space in the contracts of the word operators
WORD_SPACE = [0x20, *range(0x09, 0x0E)]

# odd multipliers of the word and shingle hashes
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, row after the last) of runs of rows with about `limit` bytes."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start, done = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield start, stop
        start, done = stop, int(ends[stop - 1])


def text_bytes(column: pa.Array, end: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets), each text followed by `end`; null is the empty text."""
    binary = pc.fill_null(column.cast(pa.large_binary()), b"")
    if end:
        binary = pc.binary_join_element_wise(binary, pa.scalar(end, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    _, offsets, data = binary.buffers()
    bounds = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def lower_table() -> np.ndarray:
    """A-Z to a-z, every other byte to itself."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_table(space: list[int]) -> np.ndarray:
    """True for the bytes of words: all but those in `space`."""
    table = np.ones(256, bool)
    table[space] = False
    return table


def word_spans(raw: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of word bytes."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = in_word[raw]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def per_document(positions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the ascending `positions` lie in each document."""
    return np.diff(np.searchsorted(positions, bounds))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * MIX
    h = h ^ (h >> np.uint64(29))
    h = h * BASE
    return h ^ (h >> np.uint64(32))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


@lru_cache(4)
def _powers(base: int, log_size: int) -> np.ndarray:
    """base ** 0, 1, 2 ... modulo 2**64."""
    out = np.full(1 << log_size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial in random byte values, by prefix sums.

    The sum of a word is divided by the power of its first position, so equal words have
    equal hashes wherever they stand.
    """
    n = len(raw)
    if not len(starts):
        return np.zeros(0, np.uint64)
    log_size = max(22, n.bit_length())
    sums = np.zeros(n + 1, np.uint64)
    terms = _byte_values()[raw]
    terms *= _powers(int(BASE), log_size)[:n]
    np.cumsum(terms, out=sums[1:])
    back = _powers(pow(int(BASE), -1, 1 << 64), log_size)
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number per document) of all runs of `width` words within a document.

    A document of fewer words, but not none, has its whole sequence as one.
    """
    counts = counts.astype(np.int64)
    full = np.maximum(counts - width + 1, 0)
    number = np.where((counts > 0) & (full == 0), 1, full)
    firsts = np.cumsum(counts) - counts
    # position of each shingle's first word: consecutive within a document
    at = np.arange(number.sum()) + np.repeat(firsts - (np.cumsum(number) - number), number)
    padded = np.append(words, np.zeros(width, np.uint64))
    out = padded[at]
    short = np.repeat((counts > 0) & (full == 0), number)
    length = np.repeat(np.minimum(counts, width), number) if short.any() else None
    for k in range(1, width):
        longer = out * BASE + padded[at + k]
        out = longer if length is None else np.where(k < length, longer, out)
    return mixed(out if length is None else out + length.astype(np.uint64) * np.where(short, MIX, 0).astype(np.uint64)), number
