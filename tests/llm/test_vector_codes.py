"""Vector codes against plain loops over all entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from stockflow.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """{row number: (code, error)}, label sums and the digest, by the rules alone."""
    sound = [k for k, (_, v, _) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(sound, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    kept = [k for k in order if len(rows[k][1]) == len(rows[order[0]][1])]
    whole = {k: [math.floor(256 * float(np.float32(x))) for x in rows[k][1]] for k in kept}
    width = len(rows[order[0]][1]) // parts
    cut = lambda k, p: whole[k][p * width : (p + 1) * width]
    books = [[cut(k, p) for k in kept[:entries]] for p in range(parts)]

    def nearest(p, part):
        apart = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in books[p]]
        return apart.index(min(apart)), min(apart)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for k in kept:
                groups.setdefault(nearest(p, cut(k, p))[0], []).append(cut(k, p))
            for entry, own in groups.items():
                books[p][entry] = [sum(c) // len(own) for c in zip(*own)]
    found = {k: [nearest(p, cut(k, p)) for p in range(parts)] for k in kept}
    codes = {k: ("".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f)) for k, f in found.items()}
    labels = {}
    for k, (_, error) in codes.items():
        labels[rows[k][2]] = labels.get(rows[k][2], 0) + error
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(
        repr((rows[k][0], code, error, labels[rows[k][2]], hashlib.sha256(text.encode()).hexdigest()))
        for k, (code, error) in codes.items()
    )


def random_rows(seed, n, dims=32, spread=0.3):
    rng = random.Random(seed)
    rows = [(k, [float(np.float32(rng.gauss(0, spread))) for _ in range(dims)], rng.choice([None, 1, 2])) for k in range(n)]
    return rows


def found(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(repr(tuple(r)) for r in vector_codes.compressed(table).collect())


@pytest.mark.parametrize(("seed", "n", "spread"), [(1, 150, 0.3), (2, 10, 0.3), (3, 200, 0.004), (4, 90, 3000.0)])
def test_codes_equal_plain_loops(spark, seed, n, spread):
    rows = random_rows(seed, n, spread=spread)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    good = random_rows(5, 70, dims=16)
    nan, inf = float("nan"), float("inf")
    odd = [
        (3, None, 1), (4, [], 1), (5, [None] * 16, 1), (6, [nan] * 16, 1), (7, [0.0] * 15 + [inf], None),
        (8, [0.1] * 17, 2), (9, [0.1] * 32, 2), (None, [0.5] * 16, None), (None, [0.5] * 16, None),
        (3, [-0.5] * 16, 7), (3, good[3][1], 7), (3, good[3][1], 7),
    ]
    assert found(spark, good + odd) == brute(good + odd)


def test_many_equal_vectors_and_a_far_one(spark):
    rows = random_rows(6, 80, dims=16)
    rows += [(1000 + k, rows[7][1], 1) for k in range(400)] + [(2000, [90_000.0] * 16, 1)]
    assert found(spark, rows) == brute(rows)


def test_nothing_to_code(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1), (2, [1.0] * 15, 1)]) == []


def test_columns_of_any_name(spark):
    rows = random_rows(7, 30, dims=16)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _vector", "2 AS code", "3 AS a", "4 AS error")
    assert sorted(repr(tuple(r)) for r in vector_codes.compressed(table).collect()) == brute(rows)


def test_cells_measure_few_entries_and_forget(spark):
    rng = np.random.default_rng(3)
    entries, parts = rng.normal(0, 32, (64, 4)).astype(np.int64), rng.normal(0, 32, (20_000, 4)).astype(np.int64)
    apart = ((parts[:, None, :] - entries[None]) ** 2).sum(2)
    for memo in (0, 1 << 16):
        cells = vector_codes.Cells(entries, memo)
        for half in (parts[:10_000], parts[10_000:]):
            nearest, distance = cells.nearest(half)
        assert (nearest == apart[10_000:].argmin(1)).all() and (distance == apart[10_000:].min(1)).all()
        assert cells.measured < 0.35 * apart.size


def test_decoded_vector_has_the_stated_error(spark):
    rows = random_rows(8, 100, dims=16)
    vectors, dims = vector_codes.kept_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    books = vector_codes.learn(vectors, dims, "vec_id")
    for vec_id, code, error in vector_codes.encode(vectors, books, ["vec_id"]).collect():
        whole = [math.floor(256 * x) for x in rows[vec_id][1]]
        assert sum((a - b) ** 2 for a, b in zip(whole, vector_codes.decoded(code, books))) == error
