"""Language filters: exact membership, held-out accuracy, and the defined cases."""

import numpy as np
import pytest
from fixtures import ODD_ROWS, clashing, frame

from stockflow.llm import language
from stockflow.llm.queries import languages, table

ENGLISH = ["the house and the garden", "there is nothing in the other room", "then they went with him"]
GERMAN = ["der hund und die katze", "ich weiß nicht was soll das", "über den fluss und durch den wald"]


def training(spark):
    rows = [(k, t, lang, "s") for k, (t, lang) in enumerate([(t, "en") for t in ENGLISH] + [(t, "de") for t in GERMAN])]
    return frame(spark, rows + [(99, "not learned from", None, "s"), (98, None, "en", "s")])


def test_filters_contain_what_was_learned(spark):
    filters = language.learn(training(spark))
    assert filters.languages == ["de", "en"]
    letters = language._letters()
    for text, bit in ((ENGLISH[0], 2), (GERMAN[0], 1)):
        for grams, _ in language.grams_of([text], letters)[0]:
            # every n-gram of a learned text that no other language has more often is contained
            assert ((filters.probe(grams)[:, 0] & bit) > 0).mean() > 0.9


def test_grams_are_those_of_the_words():
    letters = language._letters()
    (three, counts), _ = language.grams_of(["Ab, c", None, "1"], letters)[0]
    want = [" ab", "ab ", "b c", " c "]
    packed = [sum(ord(c) << 21 * (2 - k) for k, c in enumerate(w)) * 2 + 1 for w in want]
    assert three.tolist() == packed and counts.tolist() == [4, 0, 0]


def test_defined_cases(spark):
    filters = language.learn(training(spark))
    found = language.predict(clashing(frame(spark)), filters, ["doc_id"]).collect()
    assert len(found) == len(ODD_ROWS)
    by_text = {}
    texts = language.predict(frame(spark), filters, ["text"]).collect()
    for r in texts:
        by_text[r.text] = r
        assert 0 <= r.score <= 1
    for text in (None, "", " \n\t ", "12345 67890 --- !!!"):
        assert by_text[text].lang_pred == "und" and by_text[text].score == 0
    assert by_text["É ß 中文 🙂 ￿"].lang_pred in ("de", "en")
    assert by_text["The quick brown fox jumps over the lazy dog and runs away"].lang_pred == "en"


def test_nothing_to_learn_from_and_no_rows(spark):
    none = language.learn(frame(spark, []))
    assert {r.lang_pred for r in language.predict(frame(spark), none).collect()} == {"und"}
    assert language.predict(frame(spark, []), none).collect() == []
    assert language.accepted(frame(spark), none).collect() == []


def test_more_languages_than_bits_of_a_word(spark):
    rows = [(k, f"{chr(97 + k % 26)}{chr(97 + k // 26)}q " * 5, f"l{k:03d}", "s") for k in range(150)]
    filters = language.learn(frame(spark, rows))
    found = language.predict(frame(spark, rows), filters, ["lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95


def test_accepted_rows_are_whole(spark):
    rows = [*ODD_ROWS, (50, ENGLISH[1], "en", "s")]
    table_in = clashing(frame(spark, rows))
    kept = language.accepted(table_in, language.learn(training(spark)))
    assert kept.columns == table_in.columns
    texts = {r.text for r in kept.collect()}
    assert ENGLISH[1] in texts and "" not in texts and None not in texts


def test_documents_of_a_language_left_out_of_learning_go(spark):
    documents = table(spark, "/root/testdata/sf0.01", "documents")
    held_out = language.fold("doc_id", 4) == 2
    training = documents.filter(~held_out)
    held = documents.filter(held_out)
    assert language.accepted(held, language.learn(training)).count() == held.count()
    for lang in ("de", "en", "es", "fr"):
        others = language.learn(training.filter(documents.lang != lang))
        own = documents.filter(documents.lang == lang)
        assert language.accepted(own, others).count() < 0.03 * own.count()


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_held_out_accuracy(spark, folder):
    path = f"/root/testdata/{folder}"
    found = languages(spark, path).join(table(spark, path, "documents").select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").collect()
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.98
