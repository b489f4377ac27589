"""Small document tables with every awkward row, and plain rules to hold results against."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_AZ = str.maketrans(UPPER, UPPER.lower())
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = "word " * 60_000

# id, text, lang, source: nulls in every column, empty and blank texts, repeated rows, equal
# ids with different texts, a very long text
ODD_ROWS = [
    (0, "The quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (0, "The quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (0, "Another text under the same id", "en", None),
    (1, None, "en", "a"),
    (2, "", None, "b"),
    (3, " \n\t ", "de", "b"),
    (None, "A text without an id", "en", "c"),
    (None, "A text without an id", "en", "c"),
    (None, None, None, None),
    (5, "É ß 中文 🙂 ￿", "fr", "d"),
    (6, LONG, "en", "a"),
    (7, "12345 67890 --- !!!", "en", "e"),
    (8, "one", "en", "e"),
]


def frame(spark, rows=ODD_ROWS):
    full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def clashing(df):
    """The same rows with further columns named as an operator might name its own."""
    names = ["id", "mark", "node", "size", "taken", "copy", "finish", "token", "n", "rows", "text_", "_text", "hits", "items"]
    for k, name in enumerate(names):
        df = df.selectExpr("*", f"{k} AS `{name}`")
    return df


def words(text):
    return SPACE_WORD.findall((text or "").translate(LOWER_AZ))


def random_texts(seed, groups=10, vocabulary=60):
    """Groups of near copies, some of them exact, of very different sizes."""
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdef") for _ in range(3)) for _ in range(vocabulary)]
    out = []
    for _ in range(groups):
        base = [rng.choice(names) for _ in range(rng.choice([3, 6, 30, 60]))]
        for _ in range(rng.choice([1, 2, 8, 25])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(names)
            out.append(rng.choice([" ", "\n", " \t"]).join(own))
    return out
