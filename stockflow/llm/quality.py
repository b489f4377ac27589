"""Graded quality of texts by ordinal cumulative-link regression on hashed text.

A rating is a grade 0 .. G-1. One weight per hashed feature, shared by all grades, gives a
text a position on a line; ordered thresholds cut the line:

    P(grade >= j) = sigmoid(position - threshold_j)

The expected grade is the sum of these tail probabilities, and selection asks for a tail.
Features are the distinct words of the whole text and bands of simple proportions (capitals,
symbols, repetition, word length, size), hashed into a fixed number of slots.

The model is fitted on the driver on at most `SAMPLE` rated texts, those with the smallest
hashes of their ids; only their slot numbers travel. Scoring is one pass over all texts,
without a shuffle.

Defined cases: null text counts as empty and is scored as such; ratings of unknown documents
or with a null rating are not used; with several ratings of one id the lowest grade counts;
without any rating all grades are equally likely; rows with equal or null ids keep one row
each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import textbytes as tb

GRADES = 3
SLOTS = 1 << 18
SAMPLE = 20_000
EVIDENCE = 4.0  # standard errors by which a feature's presence must differ between grades
EPOCHS = 40
RATE = 0.3
DECAY = 1e-4
BATCH = 64

_WORD = re.compile(r"[^\W\d_]+")


def _band(value: float, steps: tuple[float, ...]) -> int:
    return sum(value >= s for s in steps)


def features(text: str | None) -> list[int]:
    """The distinct slots of a text."""
    text = text or ""
    words = _WORD.findall(text)
    lower = [w.lower() for w in words]
    distinct = set(lower)
    size = max(len(text), 1)
    letters = max(sum(map(len, words)), 1)
    # counted by set differences and translate, not character by character
    capitals = sum(1 for w in words if len(w) > 1 and w.isupper())
    symbols = len(text) - letters - text.count(" ") - text.count("\n")
    shapes = {
        "capitals": _band(capitals / max(len(words), 1), (0.05, 0.3, 0.7)),
        "symbols": _band(symbols / size, (0.02, 0.04, 0.07, 0.12, 0.2, 0.4)),
        "repeats": _band(len(distinct) / max(len(words), 1), (0.02, 0.1, 0.2, 0.35, 0.5, 0.7)),
        "words": _band(len(words), (1, 5, 20, 80, 300, 1000)),
        "length": _band(letters / max(len(words), 1), (2, 3, 4, 5, 6, 8, 12)),
        "lines": _band(text.count("\n") / max(len(words), 1), (0.01, 0.03, 0.1, 0.3)),
    }
    names = [f"={k}:{v}" for k, v in shapes.items()]
    marks = [f"#{c}" for c in "|#$%&*!{}<>=\\" if text.count(c) * 50 > max(len(words), 1)]
    return sorted({xxhash.xxh32_intdigest(n) % SLOTS for n in [*distinct, *names, *marks]})


@dataclass(frozen=True)
class Ordinal:
    """Weights per slot and ascending thresholds between the grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, slots: list[int]) -> np.ndarray:
        """P(grade >= j) for j = 1 .. G-1."""
        position = float(self.weights[slots].sum()) if slots else 0.0
        return 1 / (1 + np.exp(-np.clip(position - self.thresholds, -30, 30)))


def informative(rows: list[list[int]], grades: np.ndarray, n_grades: int) -> np.ndarray:
    """Per slot: whether its presence differs between the grades below and above some threshold."""
    kept = np.zeros(SLOTS, bool)
    slots = np.concatenate([np.array(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    owner = np.repeat(grades, [len(r) for r in rows])
    every = np.bincount(slots, minlength=SLOTS)
    for j in range(1, n_grades):
        high, low = int((grades >= j).sum()), int((grades < j).sum())
        if high and low:
            above = np.bincount(slots[owner >= j], minlength=SLOTS)
            share = (every + 0.5) / (high + low + 1)
            error = np.sqrt(share * (1 - share) * (1 / high + 1 / low))
            kept |= np.abs(above / high - (every - above) / low) >= EVIDENCE * error
    return kept


def fit(rows: list[list[int]], grades: np.ndarray, n_grades: int = GRADES, epochs: int = EPOCHS) -> Ordinal:
    """Maximum likelihood with AdaGrad steps; each grade weighs the same in total.

    Slots without evidence keep weight zero. The thresholds are kept in order by learning
    the logarithms of their distances.
    """
    kept = informative(rows, grades, n_grades)
    rows = [[k for k in own if kept[k]] for own in rows]
    weights = np.zeros(SLOTS, np.float64)
    scale = np.full(SLOTS, 0.01)
    base, gaps = -0.5 * (n_grades - 2), np.zeros(n_grades - 2)
    counts = np.bincount(grades, minlength=n_grades)
    share = len(grades) / np.maximum(counts, 1) / max((counts > 0).sum(), 1)
    share = np.minimum(share, 20.0)
    order = np.random.default_rng(7)
    for _ in range(epochs if len(rows) else 0):
        for batch in np.array_split(order.permutation(len(rows)), -(-len(rows) // BATCH)):
            thresholds = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            owner = np.repeat(np.arange(len(batch)), [len(rows[k]) for k in batch])
            slots = np.concatenate([np.array(rows[k], np.int64) for k in batch])
            position = np.bincount(owner, weights[slots], len(batch))
            grade = grades[batch]
            # density of a grade: difference of two sigmoids; the outer bounds are infinite
            edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
            with np.errstate(over="ignore"):
                upper = 1 / (1 + np.exp(position - edges[grade + 1]))
                lower = 1 / (1 + np.exp(position - edges[grade]))
            # d log density / d position
            slope = upper + lower - 1
            weight = share[grade]
            step = np.bincount(slots, (slope * weight)[owner], SLOTS)
            touched = np.unique(slots)
            gradient = step[touched] / len(batch) - DECAY * weights[touched]
            scale[touched] += gradient**2
            weights[touched] += RATE * gradient / np.sqrt(scale[touched])
            # thresholds: the derivative of the log density by each bound
            dense = np.maximum(upper - lower, 1e-9)
            by_bound = np.zeros(n_grades + 1)
            np.add.at(by_bound, grade + 1, weight * upper * (1 - upper) / dense)
            np.add.at(by_bound, grade, -weight * lower * (1 - lower) / dense)
            by_bound = by_bound[1:-1] / len(batch)
            base += 0.05 * by_bound.sum()
            gaps = np.clip(gaps + 0.05 * np.cumsum(by_bound[::-1])[::-1][1:] * np.exp(gaps), -3, 3)
    return Ordinal(weights, base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def _slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in tb.slices(batch.column("text")):
            part = batch.slice(a, b - a)
            rows = [features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("grade"), pa.array(rows, pa.list_(pa.int32()))], ["grade", "slots"]
            )


def grades_of(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 toxic, 1 of low quality, 2 of high quality; the lowest of an id."""
    graded = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    return graded.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def learn(documents: DataFrame, grades: DataFrame, sample: int = SAMPLE) -> Ordinal:
    """The model of at most `sample` rated documents.

    Their ids are broadcast, `sample` rows at most, so that no text moves to find them.
    """
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rated = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("grade", "text")
    rows = rated.mapInArrow(_slots, "grade int, slots array<int>").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["grade"], r["slots"]))  # the same order in every run
    return fit([r["slots"] for r in rows], np.array([r["grade"] for r in rows], np.int64))


def _scoring(model: Ordinal, keep: list[str]) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in tb.slices(batch.column("_text")):
                part = batch.slice(a, b - a)
                tails = [model.tails(features(t)).tolist() for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(tails, pa.list_(pa.float64()))], [*keep, "_tails"]
                )

    return run


def score(documents: DataFrame, model: Ordinal, keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns with tails (P(grade >= 1), ...) and expected_grade."""
    keep = documents.columns if keep is None else keep
    inner = [f"_keep{i}" for i in range(len(keep))]
    source = documents.select(*[F.col(c).alias(x) for x, c in zip(inner, keep)], F.col("text").alias("_text"))
    schema = ", ".join([f"{x} {source.schema[x].dataType.simpleString()}" for x in inner] + ["_tails array<double>"])
    out = source.mapInArrow(_scoring(model, inner), schema)
    return out.select(
        *[F.col(x).alias(c) for x, c in zip(inner, keep)],
        F.col("_tails").alias("tails"),
        F.aggregate("_tails", F.lit(0.0), lambda s, p: s + p).alias("expected_grade"),
    )
