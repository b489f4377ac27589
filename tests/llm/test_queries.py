"""The named queries: SQL answers, whole tables, and the pipeline against plain stages."""

import re

import compare
import corpus_pipeline
import pytest
import test_ngram_join
from fixtures import frame, words
from test_ngram_join import brute, rows_of

import __spark_entry__ as entry_points
from stockflow.llm import decontamination, language, mixing, pii
from stockflow.llm.oracle import ORACLE_SQL
from stockflow.llm.queries import QUERIES, table


def test_each_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(name, spark, sf_dir):
    found = QUERIES[name](spark, sf_dir)
    types = {**compare.SAME_TYPE, "boolean": "BOOLEAN"}
    compare.SAME_TYPE.update(types)
    assert compare.differences(found, compare.connect(sf_dir), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", ["op3_mixing_sources", "op9_document_fingerprints", "op2_license_scans"])
def test_native_queries_run_no_python(name, spark, sf_dir):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)


OTHER_TABLES = {
    "op11_vector_code_compression": ("embeddings", "vec_id"),
    "op12_url_filters": ("pages", "page_id"),
    "op13_conversation_repair": ("conversations", "conv_id"),
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_row_of_its_table_is_answered(name, spark, sf_dir):
    source, key = OTHER_TABLES.get(name, ("documents", "doc_id"))
    ids = table(spark, sf_dir, source).select(key)
    ids = ids.distinct() if key == "conv_id" else ids
    assert sorted(r[0] for r in QUERIES[name](spark, sf_dir).select(key).collect()) == sorted(r[0] for r in ids.collect())


def test_pipeline_equals_its_stages_one_by_one(spark, sf_dir):
    """Every stage held against a plain computation over what the stage before it kept."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "mixture"]
    documents = table(spark, sf_dir, "documents")
    rows = sorted(map(tuple, documents.collect()))
    kept = corpus_pipeline.by_language(spark, documents, sf_dir)
    assert kept.columns == documents.columns
    filters = language.learn(documents.filter(language.fold("doc_id", 4) != 2))
    names, _, known = filters.classify([r[1] for r in rows], language._letters())
    one = [r for r, n, k in zip(rows, names, known) if n != "und" and k >= language.LEAST_KNOWN]
    assert sorted(map(tuple, kept.collect())) == one and len(one) == len(rows)

    kept = corpus_pipeline.without_near_duplicates(spark, kept, sf_dir)
    found = brute([r[:2] for r in one])[0]
    two = [r for r, (doc, _, lowest) in zip(one, found) if doc == lowest]
    assert sorted(map(tuple, kept.collect())) == two and len(two) < len(one)

    kept = corpus_pipeline.without_benchmark(spark, kept, sf_dir)
    split = lambda t: decontamination.word_stream(compare_column([t]))[0].tobytes().split()
    windows = set()
    for item in table(spark, sf_dir, "benchmark").collect():
        own = split(item.text)
        windows |= {tuple(own[k : k + 10]) for k in range(max(len(own) - 9, 1))}
    three = [r for r in two if not any(tuple(split(r[1])[k : k + 10]) in windows for k in range(len(split(r[1]))))]
    assert sorted(map(tuple, kept.collect())) == three and len(three) < len(two)

    kept = corpus_pipeline.pseudonymised(spark, kept, sf_dir)
    masker = pii.Masker()
    four = [(r[0], masker.text(r[1], pii.found_in(r[1])), *r[2:]) for r in three]
    assert sorted(map(tuple, kept.collect())) == four and four != three

    taken = {r.doc_id: r.taken for r in mixing.queue(frame(spark, [(r[0], r[1], r[2], r[3]) for r in four])).collect()}
    result = corpus_pipeline.run(spark, sf_dir)
    by_id = {}
    for r in result.collect():
        by_id[r.doc_id] = by_id.get(r.doc_id, 0) + r.taken
        assert r.taken <= len(words(r.text))
    assert by_id == {d: t for d, t in taken.items() if t}


def compare_column(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())


def test_near_duplicates_go_by_five_words_at_four_fifths(spark, sf_dir, monkeypatch):
    rows = rows_of(7)
    by_op10 = {root for root in brute([r[:2] for r in rows])[1] if root is not None}
    monkeypatch.setattr(test_ngram_join, "shingles", lambda text, own=test_ngram_join.shingles: own(text, 5))
    roots = brute([r[:2] for r in rows], 80)[1]
    ids = {}
    for (doc, *_), root in zip(rows, roots):
        if root is not None:
            ids.setdefault(root, set()).add((doc is None, doc or 0))
    kept = corpus_pipeline.without_near_duplicates(spark, frame(spark, rows), sf_dir).collect()
    want = sorted(repr(None if min(own)[0] else min(own)[1]) for own in ids.values())
    assert sorted(repr(r.doc_id) for r in kept if words(r.text)) == want
    assert len(want) != len(by_op10)


def test_pipeline_of_no_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
