"""Token counts of documents: pieces are counted once per distinct pre-token.

No piece of the vocabulary holds a line end, or a space after something else than a space.
So no merge crosses the borders of a pre-token (a run of spaces with the run of other
characters behind it, or a line end), and the tokens of a text are those of its pre-tokens.
`checked_tokenizer` tests this property of the model file.

1. All texts give their pre-tokens with their frequency in the corpus.
2. Each distinct pre-token is encoded once and its number of pieces kept.
3. Each document's pre-token frequencies are joined to these numbers and summed.

Most occurrences belong to few pre-tokens. The most frequent ones, at most
`FREQUENT` of them and of bounded length, are given to every task; the rest is joined by a
shuffle. No token ids are held beyond a pre-token.

Defined cases: null text counts as empty and has no token; each row gets a row, also with
equal or null ids; special strings are ordinary text, as the library treats them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import textbytes as tb
from stockflow.session import written

FREQUENT = 1 << 19  # pre-tokens every task may hold
FREQUENT_CHARS = 48  # longest of them
HELD = 1 << 19  # distinct pre-tokens a task collects before it hands on their frequencies
OVER = 4096  # over_limit of the contract

PRE_TOKEN = re.compile(r"\n| *[^ \n]+| +")
SPACE_MARK = "▁"


def checked_tokenizer(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model, if its tokens can be counted pre-token by pre-token."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for k in range(model.vocab_size()):
        piece = model.id_to_piece(k)
        if "\n" in piece or re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", piece):
            raise ValueError(f"piece {piece!r} crosses a pre-token border")
    if model.encode("\n", out_type=str) != [SPACE_MARK, "<0x0A>"] or model.normalize(" \n  ") != SPACE_MARK + SPACE_MARK + "\n" + 2 * SPACE_MARK:
        raise ValueError("the model changes white space")
    return model


def pre_tokens(text: str | None) -> list[str]:
    """The pre-tokens of a text, the leading space included that the model puts in front.

    The model reads its own mark for a space as a space.
    """
    return PRE_TOKEN.findall(" " + text.replace(SPACE_MARK, " ")) if text else []


def n_pieces(model: sentencepiece.SentencePieceProcessor, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token within a text."""
    # the model puts a space in front; behind a line end a pre-token stands as it is
    ready = [t[1:] if t[0] == " " else "\n" + t for t in tokens]
    extra = [0 if t[0] == " " else 2 for t in tokens]
    return [
        1 if r == "" else len(ids) - more
        for r, ids, more in zip(ready, model.encode(ready, num_threads=1), extra)
    ]


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])
        seen.clear()
        return out

    for batch in batches:
        for a, b in tb.slices(batch.column("text")):
            for text in batch.column("text").slice(a, b - a).to_pylist():
                seen.update(pre_tokens(text))
            if len(seen) > HELD:
                yield rows()
    yield rows()


def _encoding(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = checked_tokenizer(path)
        for batch in batches:
            counts = n_pieces(model, batch.column("token").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("token"), batch.column("n"), pa.array(counts, pa.int64())], ["token", "n", "pieces"]
            )

    return run


def pre_token_table(documents: DataFrame, path: str) -> DataFrame:
    """token, n (occurrences in all texts), pieces: one row per distinct pre-token, written."""
    counts = documents.select("text").mapInArrow(_frequencies, "token string, n long")
    distinct = counts.groupBy("token").agg(F.sum("n").alias("n"))
    return written(distinct.mapInArrow(_encoding(path), "token string, n long, pieces long"), "pre-tokens")


def frequent_from(table: DataFrame, most: int = FREQUENT) -> int:
    """The lowest number of occurrences for which at most `most` pre-tokens reach it."""
    level = F.floor(F.log2("n") * 8)
    sizes = table.filter(F.length("token") <= FREQUENT_CHARS).groupBy(level.alias("level")).agg(
        F.count("*").alias("tokens"), F.min("n").alias("least")
    )
    total, least = 0, (1 << 62)
    for row in sorted(sizes.collect(), reverse=True):  # one row for each eighth of a doubling
        total += row["tokens"]
        if total > most:
            break
        least = row["least"]
    return least


def _summing(frequent) -> Callable:
    """Known pre-tokens are summed in the task; the others become rows to be joined."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.ipc.open_stream(frequent.value).read_all()
        pieces = dict(zip(table.column("token").to_pylist(), table.column("pieces").to_pylist()))
        for batch in batches:
            for a, b in tb.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                row, token, times, known, first, size = [], [], [], [], [], []
                bytes_of = pc.binary_length(part.column("text")).to_pylist()
                marks = part.column("mark").to_pylist()
                for k, text in enumerate(part.column("text").to_pylist()):
                    rare, total = [], 0
                    for own, n in Counter(pre_tokens(text)).items():
                        found = pieces.get(own)
                        if found is None:
                            rare.append((own, n))
                        else:
                            total += found * n
                    # a text without rare pre-tokens still needs one row; its key spreads them
                    rare = rare or [(f"\n{marks[k]}", 0)]
                    row += [k] * len(rare)
                    token += [t for t, _ in rare]
                    times += [n for _, n in rare]
                    known += [total] + [0] * (len(rare) - 1)
                    first += [1] + [0] * (len(rare) - 1)
                    size += [bytes_of[k]] + [0] * (len(rare) - 1)
                where = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(where), part.column("mark").take(where), pa.array(token, pa.string())]
                    + [pa.array(x, pa.int64()) for x in (times, known, first, size)],
                    ["id", "mark", "token", "times", "known", "first", "size"],
                )

    return run


def count_tokens(documents: DataFrame, path: str, id_column: str = "doc_id", most: int = FREQUENT) -> DataFrame:
    """`id_column`, n_bytes and n_tokens of every row of `documents`."""
    spark = documents.sparkSession
    table = pre_token_table(documents, path)
    least = frequent_from(table, most)
    common = (F.col("n") >= least) & (F.length("token") <= FREQUENT_CHARS)
    sink = pa.BufferOutputStream()
    chosen = table.filter(common).select("token", "pieces").toArrow()
    with pa.ipc.new_stream(sink, chosen.schema) as stream:
        stream.write_table(chosen)
    frequent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())

    text = F.coalesce("text", F.lit(""))
    kind = documents.schema[id_column].dataType.simpleString()
    # equal rows share a mark: they are counted together and dealt out again at the end
    source = documents.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    parts = source.mapInArrow(
        _summing(frequent), f"id {kind}, mark long, token string, times long, known long, first long, size long"
    )
    numbers = table.filter(~common).select("token", "pieces")
    sums = (
        parts.join(numbers, "token", "left")
        .groupBy("id", "mark")
        .agg(
            F.sum(F.col("known") + F.col("times") * F.coalesce("pieces", F.lit(0))).alias("pieces"),
            F.sum("first").alias("rows"),
            F.max("size").alias("size"),
        )
    )
    return (
        sums.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        .select(
            F.col("id").alias(id_column),
            F.col("size").alias("n_bytes"),
            F.expr("pieces div rows").alias("n_tokens"),
        )
    )
