"""Benchmark passages against a search word by word."""

import random
import re

import pytest
from fixtures import LOWER_AZ, ODD_ROWS, clashing, frame

from stockflow.llm.decontamination import decontaminated, find_passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER_AZ))


def brute(text, items, window):
    own, hit, found = words(text), set(), set()
    for name, item in items:
        item = words(item)
        n = min(window, len(item))
        wanted = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
        for p in range(len(own) - n + 1):
            if n and tuple(own[p : p + n]) in wanted:
                hit |= set(range(p, p + n))
                found.add(name)
    return len(own), len(hit), sorted(found)


def benchmark(spark, items):
    return clashing(spark.createDataFrame([(int(i), t) for i, t in items], "item_id long, text string"))


@pytest.mark.parametrize(("window", "block_bytes"), [(1, 1 << 20), (3, 40), (10, 1 << 20), (10, 60)])
def test_hits_and_items(spark, window, block_bytes):
    rng = random.Random(window + block_bytes)
    vocabulary = ["a", "b", "é", "ab", "ba c", "1", "x_y", "LONGERWORDthanmost"]

    def text(n):
        return rng.choice(["", "\n", "--"]) + rng.choice([" ", ", "]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(str(k), text(rng.randint(0, 14))) for k in range(8)] + [("3", "a b")]
    rows = [(k, text(rng.randint(0, 60)), "en", "s") for k in range(40)]
    rows += [(100, "x " + items[0][1] + " y", "en", "s"), *ODD_ROWS]
    found = find_passages(clashing(frame(spark, rows)), benchmark(spark, items), ["doc_id"], window, block_bytes).collect()
    got = sorted((repr(r.doc_id), r.n_words, sum(h.end - h.first for h in r.hits), sorted(r.items)) for r in found)
    assert got == sorted((repr(i), *brute(t, items, window)) for i, t, *_ in rows)
    for r in found:
        assert all(a.end < b.first for a, b in zip(r.hits, r.hits[1:]))


def test_null_items_and_no_items(spark):
    rows = [(1, "one two three", "en", "s")]
    none = spark.createDataFrame([(None, "one two"), (2, None), (3, " -- ")], "item_id long, text string")
    for table in (none, none.limit(0)):
        assert [(r.n_words, r.hits, r.items) for r in find_passages(frame(spark, rows), table).collect()] == [(3, [], [])]
    assert find_passages(frame(spark, []), none).collect() == []


def test_only_clean_documents_stay(spark):
    passage = " ".join(f"w{k}" for k in range(12))
    rows = [(1, "before " + passage.upper() + " after", "en", "s"), (2, " ".join(f"w{k}" for k in range(9)), "en", "s"), (None, None, None, None)]
    items = [("1", passage)]
    kept = decontaminated(clashing(frame(spark, rows)), benchmark(spark, items))
    assert kept.columns == clashing(frame(spark, rows)).columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["2", "None"]
