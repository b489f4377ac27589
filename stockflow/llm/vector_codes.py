"""Vectors as short codes: each of 16 parts is replaced by the nearest entry of its codebook.

Components become integers, floor(256 x). A codebook starts as the parts of the vectors with
the 64 smallest ids; rounds of assignment and averaging refine it, a last assignment gives the
codes. All arithmetic is on integers, so results do not depend on the order of rows.

Nearest entries come from memoised grid cells. A part falls into a cell of a grid; the cell's
box has for each entry a least and a greatest squared distance to its points. An entry whose
least distance is above the smallest greatest distance is dominated all over the box. The
entries that are left are stored with the cell, and only they are measured exactly for the
parts in it. The side of the cells follows the spread of the codebook; it and the size of the
memo change the time only, never a code.

Scale: each pass reads the vectors once; a task sends one row of sums per used entry, so what
is shuffled or collected is bounded by tasks and codebook and not by vectors. Codebooks
(16 x 64 entries) travel with the tasks. The memo of a task is emptied when it holds
`MEMO` cells. The seed is the head of the table by id, 64 rows.

Defined cases: rows whose vector is null or has null or non-finite components are dropped, as
are rows of another length than the vector with the smallest id, or of a length that 16 does
not divide. Null ids come last in the seed, equal ids follow their vectors' order. Fewer than
64 rows give shorter codebooks, no rows no codes. Components count as at most `limit(width)`
(2**25 for parts of 4 components, 131,072 before scaling), so that distances fit in 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.session import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
MEMO = 1 << 16
# vectors worked on at once in a task
ROWS = 4096


@dataclass(frozen=True)
class Codebooks:
    """entries[part, entry, position], whole numbers."""

    entries: np.ndarray

    @property
    def dims(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


class Cells:
    """Nearest entries of one codebook by memoised grid cells."""

    def __init__(self, entries: np.ndarray, memo: int = MEMO) -> None:
        self.entries = entries
        spread = 1.5 * float(np.median(np.abs(entries - np.median(entries, axis=0))))
        self.shift = max(int(np.log2(max(spread, 1.0))) - 1, 0)
        self.memo = memo
        self.known: dict[bytes, np.ndarray] = {}
        self.measured = 0

    def _left(self, cells: np.ndarray) -> list[np.ndarray]:
        """The entries not dominated within each cell, ascending."""
        low = cells << self.shift
        high = low + (1 << self.shift) - 1
        at = self.entries[None, :, :]
        outside = np.maximum(np.maximum(low[:, None, :] - at, at - high[:, None, :]), 0)
        across = np.maximum(np.abs(at - low[:, None, :]), np.abs(at - high[:, None, :]))
        least, greatest = (outside * outside).sum(2), (across * across).sum(2)
        left = least <= greatest.min(1)[:, None]
        return [np.flatnonzero(row) for row in left]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part; of equally near entries the first."""
        cells, inverse = np.unique(parts >> self.shift, axis=0, return_inverse=True)
        if len(self.known) > self.memo:
            self.known.clear()
        keys = [cell.tobytes() for cell in cells]
        new = [k for k, key in enumerate(keys) if key not in self.known]
        if new:
            self.known.update(zip([keys[k] for k in new], self._left(cells[new])))
        lists = [self.known[key] for key in keys]
        sizes = np.array([len(entries) for entries in lists])
        flat = np.concatenate(lists)
        starts = np.cumsum(sizes) - sizes
        inverse = inverse.reshape(-1)
        own = sizes[inverse]
        ends = np.cumsum(own)
        first = ends - own
        entry = flat[np.arange(ends[-1]) - np.repeat(first - starts[inverse], own)]
        self.measured += len(entry)
        apart = np.repeat(parts, own, axis=0) - self.entries[entry]
        # distance and entry in one number: the smallest is the nearest, then the first
        both = (apart * apart).sum(1) * len(self.entries) + entry
        best = np.minimum.reduceat(both, first)
        return best % len(self.entries), best // len(self.entries)


def limit(width: int) -> int:
    """What a component may be at most: ENTRIES times the squared distance of two parts is below 2**62."""
    return 1 << 27 - (width - 1).bit_length() // 2 - (width > 1)


def integers(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers from a list column of finite components."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    most = limit(dims // PARTS)
    whole = np.floor(np.clip(values * SCALE, -most, most)).astype(np.int64)
    return whole.reshape(-1, dims)


def _assigned(vectors: np.ndarray, cells: list[Cells]) -> tuple[np.ndarray, np.ndarray]:
    width = vectors.shape[1] // len(cells)
    found = [c.nearest(vectors[:, k * width : (k + 1) * width]) for k, c in enumerate(cells)]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _summed(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The task's count and sums of the parts of each used entry."""
    parts, entries, width = books.shape
    cells = [Cells(book) for book in books]
    sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
    for batch in _pieces(batches):
        vectors = integers(batch.column(0), parts * width)
        codes, _ = _assigned(vectors, cells)
        for k in range(parts):
            np.add.at(sums[k], codes[:, k], vectors[:, k * width : (k + 1) * width])
            counts[k] += np.bincount(codes[:, k], minlength=entries)
    part, entry = np.nonzero(counts)
    lists = pa.ListArray.from_arrays(np.arange(len(part) + 1) * width, pa.array(sums[part, entry].reshape(-1)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), lists],
        ["part", "entry", "n", "total"],
    )


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, types: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Code and error of each vector, in the place of the vector."""
    cells = [Cells(book) for book in books]
    digits = np.array([f"{k:02x}" for k in range(256)])
    for batch in _pieces(batches):
        at = batch.schema.get_field_index("_vector")
        codes, errors = _assigned(integers(batch.column(at), books.shape[0] * books.shape[2]), cells)
        text = ["".join(row) for row in digits[codes].tolist()]
        others = [c for k, c in enumerate(batch.columns) if k != at]
        yield pa.RecordBatch.from_arrays([*others, pa.array(text, pa.string()), pa.array(errors.sum(1))], schema=types)


def _finite(vector: str) -> str:
    return f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"


def kept_vectors(rows: DataFrame, ids: str, vector: str) -> tuple[DataFrame, int]:
    """Rows with a column `_vector` that can be cut, and their number of components."""
    named = rows.withColumn("_vector", F.col(vector).cast("array<double>"))
    sound = named.filter(f"_vector IS NOT NULL AND size(_vector) > 0 AND {_finite('_vector')}")
    first = sound.select(F.size("_vector").alias("n"), *_seed_order(ids)).orderBy("a", "b", "c").limit(1).collect()
    dims = first[0].n if first and first[0].n % PARTS == 0 else 0
    return sound.filter(F.size("_vector") == dims), dims


def _seed_order(ids: str) -> list[Column]:
    """Ids ascending, nulls last; equal ids by their vectors."""
    return [F.col(ids).isNull().alias("a"), F.col(ids).alias("b"), F.col("_vector").alias("c")]


def learn(vectors: DataFrame, dims: int, ids: str, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from all `vectors`, as `kept_vectors` gives them."""
    head = vectors.select(*_seed_order(ids)).orderBy("a", "b", "c").limit(ENTRIES).collect()
    seed = integers(pa.array([row.c for row in head], pa.list_(pa.float64())), dims)
    books = np.ascontiguousarray(seed.reshape(len(seed), PARTS, dims // PARTS).transpose(1, 0, 2))
    schema = "part int, entry int, n bigint, total array<bigint>"
    for _ in range(rounds):
        sums = vectors.select("_vector").mapInArrow(partial(_summed, books=books), schema)
        per_entry = sums.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("total")[k]).alias(f"t{k}") for k in range(books.shape[2])]
        )
        books = books.copy()
        for part, entry, n, *total in per_entry.collect():
            books[part, entry] = [t // n for t in total]
    return Codebooks(books)


def encode(vectors: DataFrame, books: Codebooks, keep: list[str]) -> DataFrame:
    """The columns `keep` of each vector with `code` and `error`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = vectors.select(*keep, "_vector")
    schema = vectors.select(*keep, F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")).schema
    for field in schema.fields:
        field.nullable = True
    return rows.mapInArrow(partial(_coded, books=books.entries, types=to_arrow_schema(schema)), schema)


def compressed(rows: DataFrame, ids: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every vector that can be coded.

    The errors of a label are summed in the map tasks; codes are fixed in a written table
    before, as both the sums and the rows read them.
    """
    narrow = rows.select(F.col(ids).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("embedding"))
    vectors, dims = kept_vectors(narrow, "vec_id", "embedding")
    if not dims:
        empty = narrow.limit(0).selectExpr("vec_id", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256")
        return empty.withColumnRenamed("vec_id", ids)
    books = learn(vectors, dims, "vec_id")
    coded = written(encode(vectors, books, ["vec_id", "label"]), "vector-codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("vec_id").alias(ids), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


def decoded(code: str, books: Codebooks) -> list[int]:
    """The vector a code stands for."""
    entries = [int(code[k : k + 2], 16) for k in range(0, len(code), 2)]
    return [int(x) for part, entry in enumerate(entries) for x in books.entries[part, entry]]
