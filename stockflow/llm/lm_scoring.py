"""Language-model scores of documents: a unigram base and a causal self-attention model.

Words are the runs of other than white space, A-Z lower-cased; each text ends in one end
token. The base score adds log10 of the smoothed share of each token among all training
tokens. The model reads the subwords of the words, by a public tokenizer, and gives the
log10 probability of the text (stockflow/llm/attention.py).

1. All texts are cut into subwords once; the ids are written to the shared folder together
   with the counts of words (by a 64-bit hash) and subwords of the training texts.
2. The weights of the model start from `ROUNDS` short rounds in Spark tasks over a few distinct
   training texts: the `SAMPLE` with the smallest hashes, and one in `SAMPLE_SHARE` of all.
   A task reads about `SHARD` subwords, as a stream; only sums of all tasks reach the driver,
   a table of the size of the model.
3. In a last round every task learns from all its training texts, whatever their number: the
   weights of all tasks are averaged, and the model's distributions over subwords come from the
   expected counts of every training text, summed by Spark and smoothed with the subword
   counts. Copies of a text count as often as they occur.
4. All texts are scored whole, by the model from their ids and by the base from their words.
   Frequent words, at most `FREQUENT`, are known to every task; the others are joined to their
   counts by a shuffle and summed per document.

Defined cases: null text counts as empty and has the end token only; each row gets a row,
also with equal or null ids; a null id counts as the empty text for the fold; without any
training text the model is untrained and the base has no counts.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stockflow.llm import attention
from stockflow.llm import textbytes as tb
from stockflow.llm.language import fold
from stockflow.session import written

FOLDS, HELD_OUT = 7, 2
SAMPLE = 1500
STEPS = 4000
SAMPLE_SHARE = 256
FREQUENT = 1 << 19
SHARD = 1 << 19  # subwords of a training task
SMOOTHING = 20.0
CACHED = 1 << 20  # words whose subwords a task remembers
SLICE_BYTES = 2 << 20

BEGIN, END = 1, 2  # the tokenizer's ids for both ends of a text

_IN_WORD = tb.word_table(tb.WORD_SPACE)
_LOWER = tb.lower_table()


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values ascending, a place of each, which of them stands at each place)."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    head = np.ones(len(ordered), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(ordered), np.int64)
    which[order] = np.cumsum(head) - 1
    return ordered[head], order[head], which


class Subwords:
    """Subword ids of words, each distinct word encoded once per task."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self._clear()

    def _clear(self) -> None:
        self.known, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes ascending, and their words
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, ids per word)."""
        if len(self.known) > CACHED:
            self._clear()
        values, first, place = distinct(hashes)
        at = np.searchsorted(self.known, values)
        new = np.flatnonzero((at == len(self.known)) | (np.append(self.known, np.uint64(0))[at] != values))
        if len(new):
            data = raw.tobytes()
            words = [data[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            pieces = self.model.encode(words, num_threads=1)
            number = np.arange(len(self.known), len(self.known) + len(new))
            self.known, self.numbers = np.insert(self.known, at[new], values[new]), np.insert(self.numbers, at[new], number)
            sizes = np.cumsum([len(p) for p in pieces]) + self.starts[-1]
            self.flat = np.concatenate([self.flat, np.array([i for p in pieces for i in p], np.int32)])
            self.starts = np.concatenate([self.starts, sizes])
        of = self.numbers[np.searchsorted(self.known, values)][place]
        count = self.starts[of + 1] - self.starts[of]
        at = np.repeat(self.starts[of] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return self.flat[at], count


def read_words(column: pa.Array):
    """(bytes, word starts, word ends, word hashes, words per text) of a column of texts."""
    raw, bounds = tb.text_bytes(column)
    raw = _LOWER[raw]
    starts, ends = tb.word_spans(raw, _IN_WORD)
    return raw, starts, ends, tb.word_hashes(raw, starts, ends), tb.per_document(starts, bounds)


def read_slice(column: pa.Array, subwords: Subwords):
    """(word hashes, words per text, subword ids, ids per text) of a column of texts."""
    raw, starts, ends, hashes, words = read_words(column)
    ids, count = subwords.encode(raw, starts, ends, hashes)
    total = np.concatenate([[0], np.cumsum(count)])
    edges = np.concatenate([[0], np.cumsum(words)])
    return hashes, words, ids, np.diff(total[edges])


def id_type(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def as_binary(ids: np.ndarray, count: np.ndarray, kind: np.dtype) -> pa.Array:
    """The ids of each text as bytes."""
    bounds = np.concatenate([[0], np.cumsum(count)]).astype(np.int64) * kind.itemsize
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(ids.astype(kind).tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(count), buffers).cast(pa.binary())


def from_binary(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, ids per text)."""
    raw, bounds = tb.text_bytes(column, b"")
    return raw.view(kind).astype(np.int32), np.diff(bounds) // kind.itemsize


def sequences(ids: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, lengths): each text read from its begin, up to and with its end."""
    ends = np.cumsum(per_text)
    return np.insert(ids, ends - per_text, BEGIN), np.insert(ids, ends, END), per_text + 1


COUNTED, TEXT = "kind int, key long, n long", "mark long, held_out boolean, ids binary"


def _reading(path: str, id_arrow: pa.DataType) -> Callable:
    """Texts as subword ids (kind 2), and of the training texts of a task the counts of words (kind 0, by hash) and subwords (kind 1)."""
    names = ["kind", "key", "n", "id", "mark", "held_out", "ids"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = Subwords(path)
        kind_of_id = id_type(subwords.size)
        pieces = np.zeros(subwords.size, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            values, place = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
            return values, np.bincount(place, np.concatenate([n for _, n in held]), len(values)).astype(np.int64)

        def rows(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            empty = [pa.nulls(len(key), t) for t in (id_arrow, pa.int64(), pa.bool_(), pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n), *empty], names)

        for batch in batches:
            for a, b in tb.slices(batch.column("text"), SLICE_BYTES):
                part = batch.slice(a, b - a)
                hashes, words, ids, count = read_slice(part.column("text"), subwords)
                learned = ~part.column("held_out").to_numpy(zero_copy_only=False)
                pieces += np.bincount(ids[np.repeat(learned, count)], minlength=subwords.size)
                pieces[END] += learned.sum()
                held.append(np.unique(hashes[np.repeat(learned, words)], return_counts=True))
                if len(held) > 16:
                    held[:] = [merged()]
                    if len(held[0][0]) > CACHED:
                        yield rows(0, held[0][0].view(np.int64), held[0][1])
                        held.clear()
                none = pa.nulls(len(part), pa.int64())
                text = [part.column("id"), part.column("mark"), part.column("held_out"), as_binary(ids, count, kind_of_id)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), 2, np.int32)), none, none, *text], names)
        if held:
            values, times = merged()
            yield rows(0, values.view(np.int64), times)
        yield rows(1, np.flatnonzero(pieces), pieces[pieces > 0])

    return run


def _training(packed, number: int, passes: int) -> Callable:
    """One round of training over a task's texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unpacked(packed.value)
        kind_of_id = id_type(len(model.embed))
        learner, held, size = attention.Learner(model, attention.rate_of(number), seed=number), [], 0

        def learn() -> None:
            ids, count = (np.concatenate(x) for x in zip(*held))
            learner.read(*sequences(ids, count), passes)
            held.clear()

        for batch in batches:
            for a, b in tb.slices(batch.column("ids"), SHARD):
                held.append(from_binary(batch.column("ids").slice(a, b - a), kind_of_id))
                size += len(held[-1][0])
                if size >= SHARD:
                    learn()
                    size = 0
        if held:
            learn()
        if learner.windows:
            kind, row, values = learner.rows_out()
            columns = [pa.array(values[:, m]) for m in range(attention.PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(row), *columns], ["kind", "row", *_COLUMNS])

    return run


_COLUMNS = [f"p{m}" for m in range(attention.PARTS)]
_NUMBERS = ", ".join(f"{c} double" for c in _COLUMNS)


def _summed(rows: DataFrame, *keys: str) -> tuple[pa.Table, np.ndarray]:
    """(keys, sums) of the rows of all tasks: as many as the model has."""
    table = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _COLUMNS]).toArrow()
    return table, np.stack([table.column(c).to_numpy() for c in _COLUMNS], axis=1)


def packed(model: attention.Model) -> bytes:
    out = io.BytesIO()
    np.savez(out, parts=model.parts, **model.weights())
    return out.getvalue()


def unpacked(data: bytes) -> attention.Model:
    with np.load(io.BytesIO(data)) as arrays:
        return attention.Model(**{k: arrays[k] for k in arrays.files})


def sampled(texts: DataFrame, sample: int) -> DataFrame:
    """(place, ids) of the distinct texts the weights start from: the first by hash, and a share of all."""
    placed = texts.select("mark", F.xxhash64("mark", F.lit(1)).alias("place"), "ids")
    first = placed.select("place").distinct().orderBy("place").limit(sample).agg(F.max("place").alias("last")).first()
    chosen = F.pmod("place", F.lit(SAMPLE_SHARE)) == 0
    if first["last"] is not None:
        chosen = chosen | (F.col("place") <= first["last"])
    return placed.filter(chosen).dropDuplicates(["mark"]).select("place", "ids")


def learn(training: DataFrame, counts: DataFrame, size: int, sample: int = SAMPLE, steps: int = STEPS) -> attention.Model:
    """The model of the training texts, given as `ids`; `counts` has their subwords as kind 1."""
    spark = training.sparkSession
    found = counts.filter("kind = 1").select("key", "n").toArrow()  # one row per id of the vocabulary
    unigram = np.ones(size)
    unigram[found.column("key").to_numpy()] += found.column("n").to_numpy()
    unigram /= unigram.sum()
    model = attention.new_model(unigram)

    texts = written(sampled(training, sample), "lm-sample")
    total = texts.agg(F.sum(F.length("ids") / id_type(size).itemsize + 1)).first()[0]
    if total is None:
        return model
    shards = max(1, round(total / SHARD))
    passes = int(np.clip(round(steps * attention.STRIDE * attention.BATCH * shards / total / attention.ROUNDS), 1, 8))
    # dealt once: each round reads the files, small ones several to a task
    dealt = written(texts.repartition(shards, "place").sortWithinPartitions("place").select("ids"), "lm-shards")
    # the short rounds, and the last one over all training texts, where they lie
    for number, read, times in [*((k, dealt, passes) for k in range(attention.ROUNDS)), (attention.ROUNDS, training.select("ids"), 1)]:
        now = spark.sparkContext.broadcast(packed(model))
        moved = read.mapInArrow(_training(now, number, times), f"kind long, row long, {_NUMBERS}")
        keys, sums = _summed(moved, "kind", "row")
        now.destroy()  # the round's sums are here: executors need not keep its model on disk
        model = attention.averaged(model, keys.column("kind").to_numpy(), keys.column("row").to_numpy(), sums, unigram, SMOOTHING)
    return model


def _modelling(model_bytes) -> Callable:
    """log10 probabilities of texts by the model."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = attention.Reader(unpacked(model_bytes.value))
        for batch in batches:
            for a, b in tb.slices(batch.column("ids"), SLICE_BYTES // 4):
                part = batch.slice(a, b - a)
                inputs, targets, lengths = sequences(*from_binary(part.column("ids"), id_type(len(reader.parts))))
                natural = reader.log_probabilities(inputs, targets, lengths)
                score = np.add.reduceat(natural.astype(np.float64), np.cumsum(lengths) - lengths) / np.log(10)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "mark", "held_out")), pa.array(score)], ["id", "mark", "held_out", "model"])

    return run


def _basing(frequent, denominator: float, end_count: int) -> Callable:
    """Base scores of texts; words that are not frequent become rows to be joined to their counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(frequent.value, np.int64).reshape(2, -1)
        keys, times = table[0].view(np.uint64), table[1]
        logs = np.append(np.log10((times + 1) / denominator), 0.0)
        end_log = float(np.log10((end_count + 1) / denominator))
        for batch in batches:
            for a, b in tb.slices(batch.column("text"), SLICE_BYTES):
                part = batch.slice(a, b - a)
                *_, hashes, words = read_words(part.column("text"))
                values, _, place = distinct(hashes)
                at = np.searchsorted(keys, values)
                at[at == len(keys)] = 0
                hit = keys[at] == values if len(keys) else np.zeros(len(values), bool)
                at = np.where(hit, at, len(keys))
                edges = np.concatenate([[0], np.cumsum(words)])
                log_sum = np.concatenate([[0.0], np.cumsum(logs[at][place])])
                hits = np.concatenate([[0], np.cumsum(hit[place])])
                base, known = np.diff(log_sum[edges]) + end_log, np.diff(hits[edges]) + (end_count > 0)

                # the words of each text that are not frequent, with their number
                rare = np.flatnonzero(~hit[place])
                owner = np.searchsorted(edges, rare, "right") - 1
                pairs, n = np.unique(owner * len(values) + place[rare], return_counts=True)
                owner, which = pairs // max(len(values), 1), pairs % max(len(values), 1)
                bare = np.setdiff1d(np.arange(len(words)), owner)
                row = np.concatenate([owner, bare])
                marks = part.column("mark").to_numpy()
                # a text without such words still needs a row; its key spreads them
                word = np.concatenate([values[which].view(np.int64), marks[bare]])
                number = np.concatenate([n, np.zeros(len(bare), np.int64)])
                order = np.argsort(row, kind="stable")
                row, word, number = row[order], word[order], number[order]
                first = np.diff(row, prepend=-1) != 0
                where = pa.array(row)
                once = lambda x: pa.array(np.where(first, x[row], 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(where), part.column("mark").take(where), part.column("held_out").take(where),
                        pa.array(word), pa.array(number), pa.array(first.astype(np.int64)),
                        once((words + 1).astype(np.int64)), once(known.astype(np.int64)), once(base),
                    ],
                    ["id", "mark", "held_out", "word", "times", "first", "n_tokens", "n_known", "base"],
                )

    return run


def score(documents: DataFrame, path: str, sample: int = SAMPLE, steps: int = STEPS, most: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    source = documents.select(
        F.col("doc_id").alias("id"),
        F.xxhash64(text).alias("mark"),
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        text.alias("text"),
    )
    kind = source.schema["id"].dataType
    read = written(source.mapInArrow(_reading(path, to_arrow_type(kind)), f"{COUNTED}, id {kind.simpleString()}, {TEXT}"), "lm-ids")
    texts_read = read.filter("kind = 2")
    counts = written(read.filter("kind < 2").groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    words = counts.filter("kind = 0").select("key", "n")
    size = words.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    ends = counts.filter(f"kind = 1 AND key = {END}").first()
    texts = ends["n"] if ends else 0
    train_tokens = size["n"] + texts
    denominator = float(train_tokens + size["v"] + (texts > 0) + 1)

    model = learn(texts_read.filter("NOT held_out"), counts, Subwords(path).size, sample, steps)
    least = _least_frequent(words, most)
    common = words.filter(F.col("n") >= least).orderBy(F.col("key").cast("decimal(20,0)")).toArrow()
    keys = common.column("key").to_numpy()
    order = np.argsort(keys.view(np.uint64))
    table = np.stack([keys[order], common.column("n").to_numpy()[order]]).tobytes()
    context = spark.sparkContext
    own = f"id {kind.simpleString()}, mark long, held_out boolean"
    parts = source.mapInArrow(
        _basing(context.broadcast(table), denominator, texts),
        f"{own}, word long, times long, first long, n_tokens long, n_known long, base double",
    )
    modelled = texts_read.select("id", "mark", "held_out", "ids").mapInArrow(_modelling(context.broadcast(packed(model))), f"{own}, model double")
    rare = words.filter(F.col("n") < least).select(F.col("key").alias("word"), "n")
    n = F.coalesce("n", F.lit(0))
    return (
        parts.join(rare, "word", "left")
        .withColumn("n_known", F.col("n_known") + F.when(n > 0, F.col("times")).otherwise(0))
        .withColumn("base", F.col("base") + F.col("times") * F.log10((n + 1) / denominator))
        .drop("word", "times", "n")
        .unionByName(modelled, allowMissingColumns=True)
        .groupBy("id", "mark", "held_out")
        .agg(
            F.sum("first").alias("rows"),
            *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "model")],
        )
        # equal rows share a mark: they were summed and are dealt out again
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        .select(
            F.col("id").alias("doc_id"),
            "held_out",
            F.expr("n_tokens div rows").alias("n_tokens"),
            F.expr("n_known div rows").alias("n_known"),
            F.lit(train_tokens).cast("long").alias("train_tokens"),
            (F.col("base") / F.col("rows")).alias("base_score"),
            (F.col("model") / F.col("rows")).alias("score"),
        )
    )


def _least_frequent(words: DataFrame, most: int) -> int:
    """The lowest number of occurrences for which at most `most` words reach it."""
    level = F.floor(F.log2("n") * 8)
    levels = words.groupBy(level.alias("level")).agg(F.count("*").alias("k"), F.min("n").alias("least"))
    total, least = 0, 1 << 62
    for row in sorted(levels.collect(), reverse=True):  # one row for each eighth of a doubling
        total += row["k"]
        if total > most:
            break
        least = row["least"]
    return least
