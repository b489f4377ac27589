"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source sends its documents in a fixed shuffled order, at most `COPIES` times. A
document's virtual finish time is the number of words its source has sent by then, divided
by the source's weight. The mix is all sources' documents in the order of virtual finish
times, cut off where the budget is reached. A source that has sent all its copies is done;
the others go on, so its unused share falls to them by weight.

At the cut, each source has sent the same virtual time, or everything. That time follows
from the sources' sizes alone, so the cut needs no running total over all documents. The
one document of each source that is being sent at the cut is taken up to the cut; all
others are whole.

A source's order is cut into `BUCKETS` ranges of a hash of the id; sums of whole ranges
give each range its start, so no task sorts more than one range of one source. One row per
source is ranked and filled in one task.

Defined cases: null source is a source of its own, after all others; null text and text
without words have size 0 and nothing is taken; a null id is shuffled by the text; rows
that are equal are taken one after another; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words, that the mix has
COPIES = 2
SEED = 1
BUCKET_DIGITS = 3  # hexadecimal: 4096 ranges of each source

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _sized(documents: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """The kept columns as _keep*, with source, size, place in the shuffle and its range."""
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null"), mark.cast("string")))
    return (
        documents.select(
            *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)],
            F.col("source").alias("_source"),
            word_count("text").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")).alias("_place"),
            mark.alias("_mark"),
        )
        .withColumn("_range", F.substring("_place", 1, BUCKET_DIGITS))
    )


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, copies: int) -> DataFrame:
    """One row per _source: source_size, weight and target, the words it has sent at the cut.

    Sources are ordered by the virtual time at which they have sent everything. Those that
    are done before the cut send all copies; the cut time of the others follows.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_rank") % len(weights) + 1)
    by_done = Window.orderBy("_done", "_rank")
    before = by_done.rowsBetween(Window.unboundedPreceding, -1)
    after = by_done.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        ranked.withColumn("_weight", weight)
        .withColumn("_cap", (F.col("source_size") * copies).cast("double"))
        .withColumn("_done", F.col("_cap") / F.col("_weight"))
        .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn(
            "_time",
            (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after),
        )
        .withColumn("_open", F.when(F.col("_done") > F.col("_time"), F.struct("_done", "_rank", "_time")))
        .withColumn("_cut", F.min("_open").over(everything)["_time"])
        .select(
            "_source",
            "source_size",
            F.col("_weight").alias("weight"),
            F.when(F.col("_open").isNull(), F.col("_cap")).otherwise(F.col("_cut") * F.col("_weight")).alias("target"),
        )
    )


def queue(
    documents: DataFrame,
    keep: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    copies: int = COPIES,
    seed: int = SEED,
) -> DataFrame:
    """The `keep` columns of every document with its place in the queue and what is taken.

    size: its words; source_size, weight and target of its source; sent: words its source
    sends before it in each round; taken_each: words taken of each of its copies; taken:
    their sum; finish: virtual finish time of its first copy.
    """
    keep = documents.columns if keep is None else keep
    rows = _sized(documents, keep, seed)
    ranges = rows.groupBy("_source", "_range").agg(F.sum("size").alias("_words"))
    sources = targets(ranges.groupBy("_source").agg(F.sum("_words").alias("source_size")), weights, share, copies)
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("_start", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    starts = placed.join(sources.withColumnRenamed("_source", "_s"), F.expr("_source <=> _s")).select(
        F.col("_source").alias("_s"), F.col("_range").alias("_r"), "_start", "source_size", "weight", "target"
    )
    # documents without words have no place in the queue; they need no order
    here = Window.partitionBy("_source", "_range").orderBy("_place", "_mark").rowsBetween(Window.unboundedPreceding, -1)
    filled = rows.filter("size > 0").withColumn("_before", F.coalesce(F.sum("size").over(here), F.lit(0)))
    empty = rows.filter("size = 0").withColumn("_before", F.lit(0).cast("long"))
    joined = filled.unionByName(empty).join(starts, F.expr("_source <=> _s AND _range = _r"))
    each = [
        f"greatest(0L, least(size, cast(floor(target) AS bigint) - ({k}L * source_size + _start + _before)))"
        for k in range(copies)
    ]
    return joined.select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        "size",
        "source_size",
        "weight",
        "target",
        (F.col("_start") + F.col("_before")).alias("sent"),
        F.expr(f"array({', '.join(each)})").alias("taken_each"),
        F.expr(" + ".join(each)).alias("taken"),
        ((F.col("_start") + F.col("_before") + F.col("size")) / F.col("weight")).alias("finish"),
    )


def mixture(documents: DataFrame, **settings) -> DataFrame:
    """The mix itself: one row per copy taken, in the global order of virtual finish times.

    All columns of `documents`, and size (words of the document), copy (0 for the first),
    taken (words of this copy), finish (its virtual finish time).
    """
    columns = documents.columns
    inner = [f"_column{i}" for i in range(len(columns))]
    # the columns travel as one struct: their names may be those of this operator's own
    packed = documents.withColumn("_all", F.struct(*[F.col(c).alias(x) for c, x in zip(columns, inner)]))
    sent = queue(packed, ["_all"], **settings).select(
        "_all", "size", "source_size", "weight", "sent", F.posexplode("taken_each").alias("copy", "taken")
    )
    taken = sent.filter("taken > 0").withColumn(
        "finish", (F.col("copy") * F.col("source_size") + F.col("sent") + F.col("size")) / F.col("weight")
    )
    own = [c for c in ("size", "copy", "taken", "finish") if c not in columns]
    return taken.orderBy("finish", "weight", "sent").select(
        *[F.col("_all")[x].alias(c) for x, c in zip(inner, columns)], *own
    )
