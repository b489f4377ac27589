"""Licence sentences and rules on known texts, and against the rules applied one by one."""

import pytest
from fixtures import ODD_ROWS, clashing, frame

from stockflow.llm import licenses
from stockflow.llm.queries import license_scan, table

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software, to deal in the Software without restriction.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED. In no event shall the authors or copyright holders be liable.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at a place.
Unless required by applicable law or agreed to in writing, it is as it is.
"""
CASES = {
    "Words before. Released under the MIT License. Words after.": ["MIT"],
    "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0"],
    "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.": ["CC-BY-NC-4.0", "Apache-2.0"],
    MIT: ["MIT"],
    APACHE: ["Apache-2.0"],
    "Some text\n" + MIT + "More text. And more.\n" + APACHE: ["MIT", "Apache-2.0"],
    "A license is a permission. Nobody is licensed under anything.": [],
    # too many other sentences in between: no whole text, and no reference either
    "The above copyright notice and this permission notice shall stay. " + "Other words. " * 9
    + "Permission is hereby granted, free of charge, to any person.": [],
}


@pytest.mark.parametrize("text", CASES)
def test_known_texts(spark, text):
    (row,) = licenses.scan(frame(spark, [(1, text, "en", "s")]), ["doc_id"]).collect()
    assert row.licenses == CASES[text]


def test_rules_agree_with_a_search_by_hand(spark):
    """Sequences of identifiers: at each place the first rule that fits, then on behind it."""
    import random

    names = sorted({n for rule, _ in licenses.RULES for n in rule})
    rng = random.Random(5)
    sequences = [[rng.choice(names) for _ in range(rng.randrange(9))] for _ in range(60)]
    sequences += [list(rule) * 2 for rule, _ in licenses.RULES]
    sentence = {name: forms[0] for name, forms in licenses.SENTENCES.items()}
    rows = [(k, ". ".join(sentence[n] for n in own) + ".", "en", "s") for k, own in enumerate(sequences)]
    found = {r.doc_id: r for r in licenses.scan(frame(spark, rows), ["doc_id"]).collect()}
    for k, own in enumerate(sequences):
        assert [s.name for s in found[k].sentences] == own
        want, at = [], 0
        while at < len(own):
            fit = next(((rule, name) for rule, name in licenses.RULES if tuple(own[at : at + len(rule)]) == rule), None)
            want += [fit[1]] if fit else []
            at += len(fit[0]) if fit else 1
        assert found[k].licenses == want


def test_forms_are_normal_and_leads_have_their_length():
    for name, forms in licenses.SENTENCES.items():
        for form in forms:
            assert form == " ".join(form.split()) == form.lower()
            assert name.startswith("ref-") or len(form.split()) == licenses.LEAD


def test_odd_rows_and_no_rows(spark):
    found = licenses.scan(clashing(frame(spark)), ["doc_id"]).collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in ODD_ROWS)
    assert all(r.licenses == [] for r in found)
    assert licenses.scan(frame(spark, []), ["doc_id"]).collect() == []


def test_every_licence_line_of_the_documents_is_found(spark):
    path = "/root/testdata/sf0.1"
    named = table(spark, path, "documents").filter("text RLIKE '(?i)licen'").select("doc_id")
    found = license_scan(spark, path).filter("n_licenses > 0").select("doc_id")
    assert named.exceptAll(found).count() == 0 and found.exceptAll(named).count() == 0 and found.count() > 100
