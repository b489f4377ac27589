"""Licences named or quoted in texts, by sentence-rule recognition, in DataFrame functions.

A text is cut into sentences; each is normalised (lower case, words and numbers only) and
mapped to the identifier of a known licence sentence: by its whole normal form, or by its
first `LEAD` words where the sentence is a long one of a licence's text (line breaks may cut
its end off). The identifiers of a text, in order, form a sequence in which more than
`GAP` unknown sentences leave a break. Ordered rules, each a run of identifiers, are matched
against the sequence: the leftmost first, and of several that begin there the first rule, so
full texts come before single references.

All of it happens inside the row: no shuffle, no limit on texts or matches.

Defined cases: null and empty text have no sentence and no licence; each row gives one row,
also with equal or null ids; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAD = 8
GAP = 4

# fixed values: sentences by which licences are granted or referred to, in normal form
SENTENCES: dict[str, list[str]] = {
    "ref-mit": [
        "released under the mit license",
        "licensed under the mit license",
        "this project is licensed under the mit license",
        "spdx license identifier mit",
        "mit license",
        "the mit license",
        "the mit license mit",
    ],
    "mit-grant": ["permission is hereby granted free of charge to"],
    "mit-notice": ["the above copyright notice and this permission notice"],
    "as-is": ["the software is provided as is without warranty"],
    "no-liability": ["in no event shall the authors or copyright"],
    "ref-apache-2": [
        "licensed under the apache license version 2 0",
        "apache license version 2 0",
        "this work is licensed under the apache license version 2 0",
        "released under the apache license version 2 0",
        "spdx license identifier apache 2 0",
    ],
    "apache-comply": ["you may not use this file except in"],
    "apache-copy": ["you may obtain a copy of the license"],
    "apache-basis": ["unless required by applicable law or agreed to"],
    "ref-gpl-2": [
        "this work is licensed under the gnu general public license version 2",
        "licensed under the gnu general public license version 2",
        "released under the gnu general public license version 2",
        "gnu general public license version 2",
        "spdx license identifier gpl 2 0 only",
    ],
    "ref-gpl-3": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
        "gnu general public license version 3",
        "spdx license identifier gpl 3 0 only",
    ],
    "gpl-free": ["this program is free software you can redistribute"],
    "gpl-hope": ["this program is distributed in the hope that"],
    "ref-lgpl-3": ["licensed under the gnu lesser general public license version 3", "spdx license identifier lgpl 3 0 only"],
    "bsd-redistribute": ["redistribution and use in source and binary forms"],
    "bsd-source": ["redistributions of source code must retain the above"],
    "bsd-binary": ["redistributions in binary form must reproduce the above"],
    "bsd-names": ["neither the name of the copyright holder nor"],
    "ref-bsd-3": ["licensed under the bsd 3 clause license", "spdx license identifier bsd 3 clause"],
    "ref-bsd-2": ["licensed under the bsd 2 clause license", "spdx license identifier bsd 2 clause"],
    "isc-grant": ["permission to use copy modify and or distribute"],
    "ref-mpl-2": ["this source code form is subject to the", "licensed under the mozilla public license version 2 0"],
    "ref-cc-by-4": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0"],
    "ref-cc-by-sa-4": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"],
    "ref-cc-by-nc-4": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"],
    "ref-cc-by-nd-4": ["licensed under cc by nd 4 0", "this work is licensed under cc by nd 4 0"],
    "ref-cc0": ["released under cc0 1 0", "licensed under cc0 1 0"],
    "unlicense": ["this is free and unencumbered software released into"],
}

# fixed values: which runs of identifiers make a licence; fuller runs stand first
RULES: list[tuple[tuple[str, ...], str]] = [
    (("mit-grant", "mit-notice", "as-is", "no-liability"), "MIT"),
    (("mit-grant", "mit-notice", "as-is"), "MIT"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("ref-apache-2", "apache-comply", "apache-copy", "apache-basis"), "Apache-2.0"),
    (("ref-apache-2", "apache-comply"), "Apache-2.0"),
    (("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("bsd-redistribute", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("gpl-free", "gpl-hope", "ref-gpl-2"), "GPL-2.0"),
    (("gpl-free", "gpl-hope", "ref-gpl-3"), "GPL-3.0"),
    (("gpl-free", "gpl-hope"), "GPL"),
    (("isc-grant", "as-is"), "ISC"),
    (("ref-mit",), "MIT"),
    (("ref-apache-2",), "Apache-2.0"),
    (("ref-gpl-2",), "GPL-2.0"),
    (("ref-gpl-3",), "GPL-3.0"),
    (("ref-lgpl-3",), "LGPL-3.0"),
    (("ref-bsd-3",), "BSD-3-Clause"),
    (("ref-bsd-2",), "BSD-2-Clause"),
    (("ref-mpl-2",), "MPL-2.0"),
    (("ref-cc-by-4",), "CC-BY-4.0"),
    (("ref-cc-by-sa-4",), "CC-BY-SA-4.0"),
    (("ref-cc-by-nc-4",), "CC-BY-NC-4.0"),
    (("ref-cc-by-nd-4",), "CC-BY-ND-4.0"),
    (("ref-cc0",), "CC0-1.0"),
    (("unlicense",), "Unlicense"),
]

# a sentence ends behind . ! ? ; and white space, at an empty line, or where the next
# line begins with a capital letter, digit or quote
SENTENCE_END = r"[.!?;]+[\x20\x09-\x0D]+|\n[\x20\x09]*\n|\n+(?=[A-Z0-9\x22*#/])|\n+$"
# words of which a known sentence has at least one
TRIGGER = r"(?i)licen|permission|redistribut|warranty|free software|liability|law or agreed|this file except|copy of the|name of the|hope that|permit|copyright|cc0|subject to the|unencumbered"
NOT_WORD = "[^a-z0-9]+"


def known_sentences() -> dict[str, str]:
    """Normal form, or the first LEAD words of it with a mark, to identifier."""
    known = {}
    for name, forms in SENTENCES.items():
        for form in forms:
            known[form] = name
            if len(form.split()) == LEAD:
                known[form + " *"] = name
    return known


def _map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def normal_form(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), NOT_WORD, " "))


def identifiers_of(text: Column) -> Column:
    """array<struct<at, name>>: the known sentences of a text, `at` counting all its sentences."""
    # a text without any of the words is not cut at all
    plain = F.when(text.rlike(TRIGGER), text).otherwise(F.lit(""))
    sentences = F.split(plain, SENTENCE_END)
    numbered = F.transform(sentences, lambda s, k: F.struct(k.alias("at"), s.alias("s")))
    likely = F.filter(numbered, lambda x: x["s"].rlike(TRIGGER))
    known = _map(known_sentences())

    def named(x: Column) -> Column:
        form = normal_form(x["s"])
        lead = F.concat(F.substring_index(form, " ", LEAD), F.lit(" *"))
        return F.struct(x["at"].alias("at"), F.coalesce(known[form], known[lead]).alias("name"))

    return F.filter(F.transform(likely, named), lambda x: x["name"].isNotNull())


def sequence_of(found: Column) -> Column:
    """The identifiers as text, " | " where more than GAP other sentences lie between two."""
    start = F.struct(F.lit("").alias("text"), F.lit(None).cast("int").alias("at"))

    def step(state: Column, x: Column) -> Column:
        far = x["at"] - state["at"] > GAP + 1
        return F.struct(
            F.concat(state["text"], F.when(far, F.lit("| ")).otherwise(F.lit("")), x["name"], F.lit(" ")).alias("text"),
            x["at"].alias("at"),
        )

    return F.aggregate(found, start, step, lambda s: s["text"])


def rule_pattern() -> str:
    """All rules as one pattern; of those that match at a place the first one counts."""
    return "|".join(f"{' '.join(names)} " for names, _ in RULES)


def scan(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns with sentences (known ones: at, name) and licenses (names in order)."""
    keep = documents.columns if keep is None else keep
    licence = _map({f"{' '.join(names)} ": name for names, name in RULES})
    found = documents.select(
        *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], identifiers_of(F.col("text")).alias("_found")
    )
    matches = F.regexp_extract_all(sequence_of(F.col("_found")), F.lit(rule_pattern()), F.lit(0))
    return found.select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_found").alias("sentences"),
        F.transform(matches, lambda m: licence[m]).alias("licenses"),
    )
