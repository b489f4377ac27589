"""Links and components against all pairs."""

import pytest
from fixtures import ODD_ROWS, clashing, frame, random_texts, words

from stockflow.llm.ngram_join import Rule, join_components, one_of_each


def shingles(text, width=4):
    own = words(text)
    return frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))) if own else frozenset()


def brute(rows, percent=85):
    """[(id, shingles, component)] of rows (id, text), and the root of each row."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                root[find(i)] = find(j)
    ids = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(k)] = min(ids.get(find(k), doc), doc)
    found = [(doc, len(sets[k]), ids.get(find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)]
    return found, [find(k) if sets[k] else None for k in range(len(rows))]


def rows_of(seed):
    texts = random_texts(seed)
    rows = [(3 * k, t, "en", "s") for k, t in enumerate(texts)]
    return rows + [(None, texts[0], "en", "s"), (90_001, "A b", "en", "s"), (90_002, "a B", "en", "s"), *ODD_ROWS]


@pytest.mark.parametrize(
    "limits",
    [{}, {"most": 0, "paired": 3}, {"most": 0, "paired": 3, "block": 4}, {"orders": 3, "paired": 1, "block": 7}, {"paired": 0, "block": 3}],
)
def test_components_are_those_of_all_links(spark, limits):
    rows = rows_of(5)
    found = join_components(clashing(frame(spark, rows)).repartition(5), **limits).collect()
    got = sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in found)
    assert got == sorted(map(repr, brute([r[:2] for r in rows])[0]))


def test_another_rule(spark):
    rows = rows_of(6)
    found = join_components(frame(spark, rows), Rule(4, 60)).collect()
    got = sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in found)
    assert got == sorted(map(repr, brute([r[:2] for r in rows], 60)[0]))


def test_one_document_of_each_component_stays(spark):
    rows = rows_of(7)
    table = clashing(frame(spark, rows))
    kept = one_of_each(table)
    assert kept.columns == table.columns
    stay = kept.collect()
    roots = brute([r[:2] for r in rows])[1]
    assert len(stay) == len({r for r in roots if r is not None}) + sum(r is None for r in roots)
    ids = {}
    for (doc, text, *_), root in zip(rows, roots):
        if root is not None:
            ids.setdefault(root, set()).add((doc is None, doc or 0))
    assert sorted(repr(r.doc_id) for r in stay if shingles(r.text)) == sorted(
        repr(None if min(own)[0] else min(own)[1]) for own in ids.values()
    )


def test_no_rows(spark):
    assert join_components(frame(spark, [])).collect() == []
    assert one_of_each(frame(spark, [])).collect() == []
