"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is a sequence of words. A run of `K` words holds `K - S + 1` inner runs of `S` words;
it is a closed syncmer if the smallest hash among the inner runs is that of the first or the
last one. Whether a run is chosen depends on its own words alone, so texts that share a
passage share its syncmers wherever the passage stands: they are anchors with positions.

A fingerprint has the hashes of all anchors. Two are compared as the share of common anchors
among all anchors of both. The printed form keeps those whose hash ends in enough zero bits
that about `KEPT` remain (all of them in short texts).

The next document by id is found without sorting texts as a whole: ids are cut into ranges
at quantiles and evenly between them; texts move once, to their range; the first document of
each range is also handed to the range before it. Fingerprints are made where both texts lie
in one row, so only texts are moved.

Defined cases: null and empty text have an empty fingerprint; a text of fewer than K words,
but not none, has its single words as anchors, and so has one of K words whose only run is not
chosen (longer texts always have one); two empty fingerprints are alike (1), an
empty and another one are not (0). Rows with null id come first, by a hash of their text;
rows with equal id by a hash of their text. A table of one row is its own next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.session import written

K = 4
S = 2
KEPT = 96
QUANTILES = 64
ROWS_PER_RANGE = 2000

SPACES = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def anchors_of(text: Column) -> Column:
    """array<struct<at, hash>>: the closed syncmers of a text, `at` the number of the first word."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def chosen(h: Column) -> Column:
        n = F.size(h)

        def from_inner(g: Column) -> Column:
            # K - S + 1 = 3 inner runs: the middle one must not be smaller than both others
            starts = F.sequence(F.lit(1), n - K + 1)
            closed = F.filter(
                starts,
                lambda i: F.element_at(g, i + 1) >= F.least(F.element_at(g, i), F.element_at(g, i + 2)),
            )
            return F.transform(
                closed,
                lambda i: F.struct(i.alias("at"), F.xxhash64(F.element_at(g, i), F.element_at(g, i + 2)).alias("hash")),
            )

        inner = F.zip_with(F.slice(h, 1, n - 1), F.slice(h, 2, n - 1), lambda x, y: F.xxhash64(x, y))
        single = F.transform(h, lambda x, i: F.struct((i + 1).alias("at"), x.alias("hash")))
        runs = _let(_let(inner, from_inner), lambda found: F.when(F.size(found) > 0, found).otherwise(single))
        return F.when(n >= K, runs).otherwise(single)

    return _let(hashes, chosen)


def _level_mask(count: Column) -> Column:
    """Low bits that must be zero so that at most about KEPT of `count` anchors remain."""
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(count, F.lit(1)) / KEPT))).cast("int")
    return F.expr("1L") * (F.pow(F.lit(2.0), level)).cast("long") - 1


def fingerprint_of(text: Column) -> Column:
    """array<long>: distinct anchor hashes in order of first position."""
    return F.array_distinct(F.transform(anchors_of(text), lambda a: a["hash"]))


def as_string(fingerprint: Column) -> Column:
    """The mask of the level and the hashes kept at it, in hexadecimal."""

    def printed(hashes: Column, mask: Column) -> Column:
        kept = F.filter(hashes, lambda x: x.bitwiseAND(mask) == 0)
        return F.concat_ws(" ", F.lower(F.hex(mask)), F.array_join(F.transform(kept, lambda x: F.lower(F.hex(x))), " "))

    return _let(fingerprint, lambda h: _let(_level_mask(F.size(h)), lambda m: printed(h, m)))


def likeness(a: Column, b: Column) -> Column:
    """Share of common anchors among all of both, 0 to 1."""

    def share(common: Column) -> Column:
        every = F.size(a) + F.size(b) - common
        return F.when(every == 0, F.lit(1.0)).otherwise(common / every)

    return _let(F.size(F.array_intersect(a, b)), share)


def _with_range(rows: DataFrame, quantiles: int, rows_per_range: int) -> DataFrame:
    """Add _range: ascending with (_id, _mark), about `rows_per_range` rows each."""
    share = [k / quantiles for k in range(quantiles + 1)]
    found = rows.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("_id").isNull()).alias("nulls"),
        F.percentile_approx("_id", share, 10_000).alias("cuts"),
    ).first()
    parts = max(1, -(-found["n"] // (quantiles * rows_per_range)))  # ranges between two cuts
    null_parts = max(1, -(-found["nulls"] // rows_per_range))
    cuts = sorted(set(found["cuts"] or [0]))
    low, high = cuts[:-1] or cuts, cuts[1:] or cuts
    below = F.array(*[F.lit(c) for c in low])
    above = F.array(*[F.lit(c) for c in high])
    piece = F.greatest(F.lit(1), F.size(F.filter(below, lambda c: c <= F.col("_id"))))
    first, last = F.element_at(below, piece), F.element_at(above, piece)
    width = F.greatest(last.cast("double") - first.cast("double"), F.lit(1.0))
    along = F.floor((F.col("_id").cast("double") - first.cast("double")) / width * parts)
    inside = F.least(F.greatest(along, F.lit(0)), F.lit(parts - 1))
    spread = F.floor((F.col("_mark") / 2.0**64 + 0.5) * null_parts)
    of_null = F.least(F.greatest(spread, F.lit(0)), F.lit(null_parts - 1)) - null_parts
    return rows.withColumn("_range", F.when(F.col("_id").isNull(), of_null).otherwise(piece * parts + inside).cast("long"))


def with_next(
    documents: DataFrame, quantiles: int = QUANTILES, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """doc_id, text (null: empty); next_text, the text of the next document."""
    text = F.coalesce("text", F.lit(""))
    plain = documents.select(F.col("doc_id").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_mark"))
    ranged = _with_range(plain, quantiles, rows_per_range)
    place = F.struct(F.col("_id").isNotNull().alias("known"), "_id", "_mark")
    firsts = ranged.groupBy("_range").agg(F.min(place).alias("_first"))
    # one row per range; the last range is followed by the first
    firsts = written(firsts, "first-of-range")
    every = Window.partitionBy()
    before = (
        firsts.withColumn("_to", F.coalesce(F.lag("_range").over(Window.orderBy("_range")), F.max("_range").over(every)))
        .select("_range", "_to", F.col("_first._id").alias("_first_id"), F.col("_first._mark").alias("_first_mark"))
    )
    same = F.expr("_range = _r AND _id <=> _first_id AND _mark = _first_mark")
    handed = (
        ranged.join(before.withColumnRenamed("_range", "_r"), same)
        .groupBy("_to")
        .agg(F.min(F.struct("_mark", "_text", "_id")).alias("_row"))
        .select(
            F.col("_row._id").alias("_id"), F.col("_row._text").alias("_text"), F.col("_row._mark").alias("_mark"),
            F.col("_to").alias("_range"),
        )
    )
    rows = ranged.withColumn("_handed", F.lit(0)).unionByName(handed.withColumn("_handed", F.lit(1)))
    order = Window.partitionBy("_range").orderBy("_handed", F.col("_id").asc_nulls_first(), "_mark")
    return (
        rows.withColumn("_next", F.lead("_text").over(order))
        .filter("_handed = 0")
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_text").alias("text"),
            F.col("_next").alias("next_text"),
        )
    )


def edited_likeness(documents: DataFrame, **ranges) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likenesses.

    Edited: the last floor(n_chars / 4) code points give way to as many first ones of the
    next document, or all it has.
    """
    pairs = with_next(documents, **ranges).withColumn("n_chars", F.char_length("text").cast("long"))
    tail = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - tail), F.left("next_text", tail))
    texts = pairs.withColumn("_edited", edited)
    prints = texts.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        F.struct(
            fingerprint_of(F.col("text")).alias("own"),
            fingerprint_of(F.col("_edited")).alias("edit"),
            fingerprint_of(F.col("next_text")).alias("next"),
        ).alias("_prints"),
    )

    def columns(p: Column) -> Column:
        return F.struct(
            as_string(p["own"]).alias("fingerprint"),
            as_string(p["edit"]).alias("edited_fingerprint"),
            likeness(p["own"], p["edit"]).alias("near_edited"),
            likeness(p["own"], p["next"]).alias("near_next"),
        )

    found = prints.withColumn("_found", _let(F.col("_prints"), columns))
    return found.select("doc_id", "n_chars", "edited_sha256", "_found.*")
