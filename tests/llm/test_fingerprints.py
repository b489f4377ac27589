"""Fingerprints against the definition, and the next document against a sorted list."""

import hashlib

import pytest
from fixtures import ODD_ROWS, clashing, frame, random_texts
from pyspark.sql import functions as F

from stockflow.llm import fingerprints as fp


def syncmers(words, k=4, s=2, order=hash):
    """Places of the k-runs whose smallest inner s-run is the first or the last."""
    inner = [order(tuple(words[i : i + s])) for i in range(len(words) - s + 1)]
    found = []
    for i in range(len(words) - k + 1):
        own = inner[i : i + k - s + 1]
        if min(own) in (own[0], own[-1]):
            found.append(i + 1)
    return found


def test_anchors_are_the_closed_syncmers(spark):
    texts = random_texts(3) + ["", "one", "one two", "one two three", "one two three four"]
    texts += [f"a{k} b{k} c{k} d{k}" for k in range(60)]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    words = F.filter(F.split("text", fp.SPACES), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    inner = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(1))),
        lambda i: F.xxhash64(F.get(hashes, i - 1), F.get(hashes, i)),
    )
    for row in table.select("text", fp.anchors_of(F.col("text")).alias("anchors"), inner.alias("inner")).collect():
        own = row.text.split()
        assert bool(row.anchors) == bool(own)
        place = {tuple(own[i : i + 2]): row.inner[i] for i in range(len(own) - 1)}
        runs = syncmers(own, order=place.get) if len(own) >= 4 else []
        if not runs:
            assert len(own) <= 4
            assert [a.at for a in row.anchors] == list(range(1, len(own) + 1))
        else:
            assert [a.at for a in row.anchors] == runs


def test_long_texts_have_short_fingerprints_and_equal_texts_equal_ones(spark):
    long = " ".join(f"w{k}" for k in range(40_000))
    rows = [(1, long, "en", "s"), (2, long, "en", "s"), (3, "x " * 50_000, "en", "s")]
    found = fp.edited_likeness(frame(spark, rows)).collect()
    by = {r.doc_id: r for r in found}
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_next == 1
    assert len(by[1].fingerprint) < 17 * 2 * fp.KEPT
    assert by[3].near_next == 0 and by[1].near_edited > 0.4


@pytest.mark.parametrize("ranges", [{}, {"quantiles": 3, "rows_per_range": 2}])
def test_edited_texts(spark, ranges):
    rows = [(7 * k * k, t, "en", "s") for k, t in enumerate(random_texts(8, groups=6))] + [(k, f"t{k} é🙂 {k}", "en", "s") for k in range(9001, 9020)]
    found = {r.doc_id: r for r in fp.edited_likeness(clashing(frame(spark, rows)).repartition(4), **ranges).collect()}
    ordered = sorted(rows)
    for k, (doc, text, *_) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        tail = len(text) // 4
        edited = text[: len(text) - tail] + after[:tail]
        assert found[doc].n_chars == len(text)
        assert found[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[doc].near_edited <= 1
        if text.split() == after.split():
            assert found[doc].near_next == 1
        if edited == text:
            assert found[doc].near_edited == 1 and found[doc].fingerprint == found[doc].edited_fingerprint


def test_likeness_is_that_of_all_anchors(spark):
    """Against sets of all anchors, in texts whose printed form keeps few of them."""
    texts = random_texts(5)[:20] + [f"a{k} b{k} c{k} d{k}" for k in range(40)]
    texts += [" ".join(f"w{k % 700}x{k // (n * 90)}" for k in range(n * 100)) for n in range(1, 9)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    found = {r.doc_id: r for r in fp.edited_likeness(frame(spark, rows)).collect()}
    forms, pairs = [], []
    for k, t in enumerate(texts):
        after, tail = texts[(k + 1) % len(texts)], len(t) // 4
        forms += [t, t[: len(t) - tail] + after[:tail]]
        pairs.append((t, forms[-1], after))
    table = spark.createDataFrame([(t,) for t in set(forms)], "text string")
    hashes = {r.text: {a.hash for a in r.anchors} for r in table.select("text", fp.anchors_of(F.col("text")).alias("anchors")).collect()}

    def alike(a, b):
        x, y = hashes[a], hashes[b]
        return len(x & y) / len(x | y) if x | y else 1.0

    assert max(map(len, hashes.values())) > 3 * fp.KEPT
    for k, (own, edited, after) in enumerate(pairs):
        assert found[k].near_edited == pytest.approx(alike(own, edited))
        assert found[k].near_next == pytest.approx(alike(own, after))


def test_odd_rows_one_row_and_none(spark):
    found = fp.edited_likeness(clashing(frame(spark)), quantiles=2, rows_per_range=2).collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in ODD_ROWS)
    (only,) = fp.edited_likeness(frame(spark, [(1, "abcdefgh", "en", "s")])).collect()
    assert only.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and only.near_next == 1
    assert fp.edited_likeness(frame(spark, [])).collect() == []
