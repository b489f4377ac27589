"""The mix against a water-filling loop and its own order."""

import pytest
from fixtures import ODD_ROWS, clashing, frame, words

from stockflow.llm.mixing import mixture, queue


def fill(sizes, weights, share=1.5, copies=2):
    """Targets by handing the excess of full sources to the others until none is above."""
    total = share * sum(sizes)
    full = set()
    while True:
        left = total - sum(copies * sizes[k] for k in full)
        open_weight = sum(w for k, w in enumerate(weights) if k not in full)
        target = [copies * s if k in full else left * weights[k] / open_weight for k, s in enumerate(sizes)]
        above = {k for k, s in enumerate(sizes) if k not in full and target[k] >= copies * s}
        if not above:
            return target
        full |= above


def rows_of(n):
    return [(k, "w " * (1 + k * 7919 % 40), "en", ["a", "b", "B", "é", None][k * k % 5]) for k in range(n)]


@pytest.mark.parametrize("rows", [rows_of(200), ODD_ROWS, rows_of(3)])
def test_targets_and_taken_words(spark, rows):
    found = queue(clashing(frame(spark, rows))).collect()
    assert len(found) == len(rows)
    totals = {}
    for _, text, _, source in rows:
        totals[source] = totals.get(source, 0) + len(words(text))
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, fill([totals[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))])))
    taken = dict.fromkeys(order, 0)
    for r in found:
        assert r.source_size == totals[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r[-2] <= 2 * len(words(r.text))
        taken[r.source] += r[-2]
    for source in order:
        assert 0 <= target[source] - taken[source] < 1


def test_reruns_and_other_layouts_agree(spark):
    table = frame(spark, rows_of(300))
    one = sorted(map(repr, queue(table, ["doc_id"]).collect()))
    assert one == sorted(map(repr, queue(table.repartition(9), ["doc_id"]).collect()))


def test_the_mix_is_in_order_of_virtual_time(spark):
    table = frame(spark, rows_of(300))
    mixed = mixture(table)
    assert mixed.columns == [*table.columns, "size", "copy", "taken", "finish"]
    rows = mixed.collect()
    assert [r.finish for r in rows] == sorted(r.finish for r in rows)
    total = sum(len(words(t)) for _, t, *_ in rows_of(300))
    assert abs(sum(r.taken for r in rows) - 1.5 * total) < 5
    # only the document that a source sends at the cut is taken in part
    assert sum(r.taken < r.size for r in rows) <= 5


def test_no_rows_and_clashing_columns(spark):
    assert queue(frame(spark, [])).collect() == [] and mixture(frame(spark, [])).collect() == []
    assert mixture(clashing(frame(spark))).columns == clashing(frame(spark)).columns
