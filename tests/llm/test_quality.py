"""Ordinal regression: recovers an order, finds toxic documents, and the defined cases."""

import numpy as np
from fixtures import ODD_ROWS, clashing, frame

from stockflow.llm import quality
from stockflow.llm.queries import graded_quality, table


def test_order_of_grades_is_recovered():
    draw = np.random.default_rng(2)
    grades = draw.integers(0, 3, 600)
    rows = [[10 * g + int(draw.integers(0, 3)) for _ in range(2)] + [500 + int(draw.integers(0, 300))] for g in grades]
    model = quality.fit([sorted(set(r)) for r in rows], grades)
    tails = np.array([model.tails(r) for r in rows])
    assert model.thresholds[0] < model.thresholds[1]
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails > 0.5).sum(1) == grades).mean() > 0.95
    # a slot that says nothing about the grade keeps weight zero
    assert (model.weights[500:800] != 0).mean() < 0.05


def test_held_out_documents(spark):
    path = "/root/testdata/sf0.1"
    documents, labels = table(spark, path, "documents"), table(spark, path, "labels")
    model = quality.learn(documents, quality.grades_of(labels.filter("doc_id % 5 <> 0")))
    held = documents.join(quality.grades_of(labels.filter("doc_id % 5 = 0")), "doc_id")
    rows = quality.score(held, model, ["grade"]).collect()
    toxic = np.array([r.tails[0] < 0.5 for r in rows])
    grade = np.array([r.grade for r in rows])
    assert toxic[grade == 0].mean() > 0.75 and toxic[grade > 0].mean() < 0.02
    assert np.mean([round(r.expected_grade) == r.grade for r in rows]) > 0.9
    assert all(abs(r.expected_grade - sum(r.tails)) < 1e-12 for r in rows)


def test_defined_cases(spark):
    labels = spark.createDataFrame(
        [(0, 1, 0), (0, 0, 1), (1, 1, 0), (2, None, 0), (None, 1, 1), (999, 1, 0)], "doc_id long, quality int, toxic int"
    )
    grades = {r.doc_id: r.grade for r in quality.grades_of(clashing(labels)).collect()}
    assert grades == {0: 0, 1: 2, 999: 2}
    for rated in (labels, labels.limit(0)):
        model = quality.learn(clashing(frame(spark)), quality.grades_of(rated))
        found = quality.score(clashing(frame(spark)), model, ["doc_id"]).collect()
        assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in ODD_ROWS)
        assert all(0 <= r.expected_grade <= 2 for r in found)
    assert quality.score(frame(spark, []), model).collect() == []


def test_the_sample_is_bounded_and_repeats(spark):
    path = "/root/testdata/sf0.01"
    documents, grades = table(spark, path, "documents"), quality.grades_of(table(spark, path, "labels"))
    one, again = (quality.learn(documents.repartition(n), grades, sample=150) for n in (2, 5))
    assert (one.weights == again.weights).all()


def test_query_has_every_document(spark, sf_dir):
    found = graded_quality(spark, sf_dir)
    assert found.count() == table(spark, sf_dir, "documents").count()
    assert found.filter("keep = toxic").count() == 0
