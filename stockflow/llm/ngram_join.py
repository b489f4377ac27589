"""Exact Jaccard self-join on word n-grams, and its connected components.

A document is the set of its distinct n-word shingles (64-bit hashes). Two documents can
reach the wanted similarity only if the first few shingles of both, in any fixed order of
all shingles, have one in common. The join asks this under several orders at once and
verifies only pairs that pass under each of them:

1. Documents with the same set are one node. Links are looked for between nodes.
2. Shingles that many documents share go last in every order. Which these are is counted
   over all documents, task by task; the result is the same for any choice of them.
3. Each order gives each node its prefix. Nodes that meet in a rare shingle are paired
   within the task of that shingle; a pair stays if it was met in every order, or if both
   sides are in a crowd in the orders in which it was not.
4. A crowd is what meets in a frequent shingle, or in another one that proves too common
   to pair. It joins the group of the smallest node with that shingle; groups are cut into blocks, and each pair of blocks is
   one unit of work that gives a spanning forest of its links, not its pairs.
5. Verification counts the common shingles of the whole texts, in integers.

Links form components by star contraction over written tables. Nothing is capped: the
limits below only decide which of the two exact ways a shingle or a group takes.

Defined cases: null text, empty text and text without words have no shingle, no link and
their own id as component; a row with null id takes part and gets the smallest id of its
component, null if there is none; repeated rows keep one row each; rows that share an id
but not a text are documents of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm import textbytes as tb
from stockflow.llm.components import components
from stockflow.session import written

WIDTH = 4
PERCENT = 85
ORDERS = 2
RARE_BELOW = 8  # documents with a shingle from which on it goes last
FREQUENT = 1 << 20  # shingles that may go last: 8 MB in every task
PAIRED = 32  # nodes with a rare shingle up to which they are paired
BLOCK = 512  # nodes of a block of a group
PENDING = 8 << 20  # shingles a task holds while it counts
FILTER_BITS = 26  # of the bitmap of nodes to be verified: 8 MB in every task

_IN_WORD = tb.word_table(tb.WORD_SPACE)
_LOWER = tb.lower_table()


@dataclass(frozen=True)
class Rule:
    width: int = WIDTH
    percent: int = PERCENT

    def linked(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (a + b - common)

    def prefix(self, sizes: np.ndarray) -> np.ndarray:
        """Shingles of a set that hold one of any set similar enough to it."""
        return sizes - -(-self.percent * sizes // 100) + 1


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, bounds = tb.text_bytes(column)
    raw = _LOWER[raw]
    starts, ends = tb.word_spans(raw, _IN_WORD)
    hashes = tb.word_hashes(raw, starts, ends)
    found, number = tb.shingle_hashes(hashes, tb.per_document(starts, bounds), width)
    return [np.unique(own) for own in np.split(found, np.cumsum(number)[:-1])] if len(number) else []


def node_of(own: np.ndarray) -> int:
    """One number for a set, whatever the order of its members; 0 for the empty set."""
    if not len(own):
        return 0
    with np.errstate(over="ignore"):
        total = tb.mixed(own * tb.MIX + tb.BASE).sum(dtype=np.uint64)
        return int(tb.mixed(np.array([total + np.uint64(len(own))]))[0].astype(np.int64))


def _survey(width: int) -> Callable:
    """A row per document (id, mark, n, node), and shingles that several sets of a task have (token, n)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def repeated() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            values, times = values[times > 1].view(np.int64), times[times > 1].astype(np.int64)
            none = pa.nulls(len(values), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, pa.array(times), none, pa.array(values)], ["id", "mark", "n", "node", "token"]
            )

        for batch in batches:
            for a, b in tb.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                sets = shingle_sets(part.column("text"), width)
                nodes = [node_of(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("mark"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.nulls(len(sets), pa.int64()),
                    ],
                    ["id", "mark", "n", "node", "token"],
                )
                for node, own in zip(nodes, sets):
                    if node not in seen:
                        seen.add(node)
                        held.append(own)
                        size += len(own)
                if size > PENDING:
                    yield repeated()
                    held.clear()
                    seen.clear()
                    size = 0
        yield repeated()

    return run


def _new_sets(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, list[int], list[int], list[np.ndarray]]]:
    """(texts, kept rows, their nodes, their sets): equal sets once per task."""
    seen: set[int] = set()
    for batch in batches:
        for a, b in tb.slices(batch.column("text")):
            column = batch.column("text").slice(a, b - a)
            sets = shingle_sets(column, width)
            rows, nodes = [], []
            if len(seen) > 1 << 20:
                seen.clear()  # a set may then come twice, which later steps allow
            for k, own in enumerate(sets):
                node = node_of(own)
                if len(own) and node not in seen:
                    seen.add(node)
                    rows.append(k)
                    nodes.append(node)
            yield column, rows, nodes, [sets[k] for k in rows]


def frequent_shingles(counts: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """At most `most` shingles that `RARE_BELOW` or more documents share, ascending."""
    summed = counts.groupBy("token").agg(F.sum("n").alias("n"))
    table = written(summed.filter(F.col("n") >= RARE_BELOW), "frequent-shingles")
    level = F.floor(F.log2("n") * 8)
    levels = table.groupBy(level.alias("level")).agg(F.count("*").alias("k"), F.min("n").alias("least"))
    total, least = 0, 1 << 62
    for row in sorted(levels.collect(), reverse=True):  # one row for each eighth of a doubling
        total += row["k"]
        if total > most:
            break
        least = row["least"]
    chosen = table.filter(F.col("n") >= least).select("token").toArrow()
    return np.sort(chosen.column("token").to_numpy().view(np.uint64))


def _prefixes(frequent, rule: Rule, orders: int) -> Callable:
    """(turn, token, often, node, n): the prefix of every node under every order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.frombuffer(frequent.value, np.uint64)
        # most shingles are told apart from the frequent ones by a table of their low bits
        low = np.uint64((1 << 22) - 1)
        maybe = np.zeros(1 << 22, bool)
        maybe[last & low] = True
        for _, _, nodes, sets in _new_sets(batches, rule.width):
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets], np.int64)
            tokens = np.concatenate(sets)
            often = maybe[tokens & low]
            some = np.flatnonzero(often)
            often[some] = last[np.minimum(np.searchsorted(last, tokens[some]), len(last) - 1)] == tokens[some]
            ends = np.cumsum(sizes).tolist()
            lengths = rule.prefix(sizes)
            owner = np.repeat(np.array(nodes, np.int64), lengths)
            number = np.repeat(sizes, lengths)
            for turn in range(orders):
                salt = np.uint64((turn + 1) * int(tb.BASE) % (1 << 64))
                place = (tb.mixed(tokens ^ salt) >> np.uint64(1)) | (often.astype(np.uint64) << np.uint64(63))
                first = np.concatenate(
                    [
                        np.argpartition(place[end - n : end], p - 1)[:p] + (end - n)
                        for end, n, p in zip(ends, sizes.tolist(), lengths.tolist())
                    ]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(first), turn, np.int32)),
                        pa.array(tokens[first].view(np.int64)),
                        pa.array(often[first]),
                        pa.array(owner),
                        pa.array(number),
                    ],
                    ["turn", "token", "often", "node", "n"],
                )

    return run


def _pairs(rule: Rule, paired: int) -> Callable:
    """What comes of the meetings in a rare shingle: (crowded, turn, a, b).

    Pairs of nodes whose sizes allow a link; where more than `paired` nodes meet, the rows
    (shingle, node) instead, as for the frequent shingles, which are not paired at all.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        turn, token, often, node, n = (table.column(c).to_numpy() for c in ("turn", "token", "often", "node", "n"))
        passed = np.unique(np.stack([turn[often].astype(np.int64), token[often], node[often]]), axis=1)
        turn, token, node, n = turn[~often], token[~often], node[~often], n[~often]
        order = np.lexsort((n, token, turn))
        turn, token, node, n = turn[order], token[order], node[order], n[order]
        alone = np.ones(len(token) + 1, bool)
        alone[1:-1] = (token[1:] != token[:-1]) | (turn[1:] != turn[:-1])
        group = np.cumsum(alone[:-1]) - 1
        large = np.bincount(group)[group] > paired
        crowd = np.unique(np.stack([turn[large].astype(np.int64), token[large], node[large]]), axis=1)
        turn, token, node, n, group = (x[~large] for x in (turn, token, node, n, group))
        found = []
        # within a group sizes ascend: each row meets those behind it, one step at a time,
        # until the next is in another group or too large
        live = np.arange(len(token))
        step = 1
        while len(live):
            live = live[live + step < len(token)]
            other = live + step
            near = (group[other] == group[live]) & (100 * n[live] >= rule.percent * n[other])
            live, other = live[near], other[near]
            a, b = np.minimum(node[live], node[other]), np.maximum(node[live], node[other])
            differ = a != b
            found.append(np.stack([turn[live][differ].astype(np.int64), a[differ], b[differ]]))
            step += 1
        rows = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((3, 0), np.int64)
        for crowded, out in ((False, rows), (True, crowd), (True, passed)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(out.shape[1], crowded)), *[pa.array(r) for r in out]], ["crowded", "turn", "a", "b"]
            )

    return run


def meetings(prefixes: DataFrame, rule: Rule, paired: int = PAIRED) -> DataFrame:
    """The written outcome of `_pairs`.

    The rows of a rare shingle lie in one partition, and are never many; those of a
    frequent one need not meet here and are spread by their nodes.
    """
    key = F.when(F.col("often"), F.col("node")).otherwise(F.col("token"))
    laid = prefixes.withColumn("key", key).repartition("turn", "key").drop("key")
    return written(laid.mapInArrow(_pairs(rule, paired), "crowded boolean, turn long, a long, b long"), "meetings")


def candidate_pairs(met: DataFrame, crowd: DataFrame, orders: int) -> DataFrame:
    """(a, b): pairs that met in a rare shingle and cannot be excluded by any order."""
    turns = met.filter("NOT crowded").groupBy("a", "b").agg(F.expr("bit_or(shiftleft(1, cast(turn AS int)))").alias("met"))
    # in an order in which both sides are in a crowd, they may meet there
    crowded = crowd.groupBy("node").agg(F.expr("bit_or(shiftleft(1, turn))").alias("crowd"))
    every = (1 << orders) - 1
    return (
        turns.join(crowded.select(F.col("node").alias("a"), F.col("crowd").alias("_a")), "a", "left")
        .join(crowded.select(F.col("node").alias("b"), F.col("crowd").alias("_b")), "b", "left")
        .filter((F.col("met").bitwiseOR(F.coalesce("_a", F.lit(0)).bitwiseAND(F.coalesce("_b", F.lit(0))))) == every)
        .select("a", "b")
    )


def crowded_blocks(crowd: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lead, i, j, node, side): nodes that meet in a frequent shingle, by pairs of blocks."""
    often = crowd.filter("turn = 0").select("token", "node")
    leads = often.groupBy("token").agg(F.min("node").alias("lead"), F.max("node").alias("other")).filter("lead < other")
    grouped = often.join(leads.select("token", "lead"), "token").select("lead", "node").distinct()
    sizes = grouped.groupBy("lead").agg(F.count("*").alias("size"))
    placed = (
        grouped.join(sizes, "lead")
        .withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    return placed.select(
        "lead",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "node",
    )


def _wanted_texts(bitmap, width: int) -> Callable:
    """(node, packed text) of the nodes whose bit is set, once per task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.int64)
        packer = zstandard.ZstdCompressor(level=3)
        for column, rows, nodes, _ in _new_sets(batches, width):
            at = _bit_of(np.array(nodes, np.int64))
            some = (bits[at >> 6] >> (at & 63)) & 1 == 1
            texts = column.cast(pa.large_binary()).take(pa.array(np.array(rows, np.int64)[some])).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(nodes, np.int64)[some]), pa.array([packer.compress(t) for t in texts], pa.binary())],
                ["node", "text"],
            )

    return run


def _bit_of(nodes: np.ndarray) -> np.ndarray:
    return nodes & ((1 << FILTER_BITS) - 1)


def _bit_words(nodes: DataFrame) -> DataFrame:
    """(word, bits): the bits of the column node as at most 2 ** (FILTER_BITS - 6) words.

    A filter of a fixed size: it may let others pass, but none of these nodes is missed.
    """
    return (
        nodes.select(_word_of("node").alias("word"), _place_of("node").alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    )


def _word_of(column: str) -> Column:
    return F.shiftright(F.col(column).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), 6)


def _place_of(column: str) -> Column:
    return F.col(column).bitwiseAND(F.lit(63)).cast("int")


def _bitmap(nodes: DataFrame) -> bytes:
    words = _bit_words(nodes).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.tobytes()


def _forest(sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Tree edges of the link graph of a block pair; counts by products of 0/1 matrices."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column, minlength=len(values)) > 1
    number = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(shared.sum()), 2048):
        a, b = np.searchsorted(column, [first, first + 2048])
        part = np.zeros((len(sets), 2048), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        common += part @ part.T
    linked = rule.linked(np.rint(common).astype(np.int64), sizes[:, None], sizes[None, :])
    np.fill_diagonal(linked, False)
    new, edges = np.ones(len(sets), bool), []
    for root in range(len(sets)):
        if not new[root]:
            continue
        new[root] = False
        front = [root]
        while front:
            at = front.pop()
            reached = np.flatnonzero(linked[at] & new)
            new[reached] = False
            edges += [(at, int(k)) for k in reached]
            front += reached.tolist()
    return edges


def _verifying(rule: Rule) -> Callable:
    """Edges of links; the rows of a unit (lead, i, j) come one after another."""

    def unit(lead: int, i: int, nodes: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        if i >= 0:
            return [(int(nodes[x]), int(nodes[y])) for x, y in _forest(sets, rule)]
        centre = next((s for node, s in zip(nodes, sets) if node == lead), None)
        edges = []
        if centre is not None:
            for node, own in zip(nodes.tolist(), sets):
                at = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
                common = int((centre[at] == own).sum())
                if node != lead and rule.linked(common, len(centre), len(own)):
                    edges.append((lead, node))
        return edges

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdDecompressor()
        key, nodes, sets = None, [], []
        edges: list[tuple[int, int]] = []

        def closed() -> list[tuple[int, int]]:
            unique = {n: s for n, s in zip(nodes, sets)}  # a text may come from several tasks
            return unit(key[0], key[1], np.array(list(unique), np.int64), list(unique.values())) if len(unique) > 1 else []

        for batch in batches:
            for a, b in tb.slices(batch.column("text"), tb.SLICE_BYTES // 4):
                part = batch.slice(a, b - a)
                keys = list(zip(*(part.column(c).to_pylist() for c in ("lead", "i", "j"))))
                own = part.column("node").to_pylist()
                texts = pa.array([packer.decompress(t) for t in part.column("text").to_pylist()], pa.large_binary())
                for k, found in enumerate(shingle_sets(texts, rule.width)):
                    if keys[k] != key:
                        edges += closed() if key else []
                        key, nodes, sets = keys[k], [], []
                    nodes.append(own[k])
                    sets.append(found)
                if edges:
                    yield _edge_batch(edges)
                    edges = []
        if key:
            yield _edge_batch(closed())

    return run


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = (np.array(x, np.int64) for x in zip(*edges)) if edges else (np.zeros(0, np.int64),) * 2
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def links(
    texts: DataFrame,
    counts: DataFrame,
    rule: Rule = Rule(),
    orders: int = ORDERS,
    most: int = FREQUENT,
    paired: int = PAIRED,
    block: int = BLOCK,
) -> DataFrame:
    """(a, b): edges between nodes whose components are those of all links.

    `counts` are the shingles that tasks found repeated (token, n). Pairs that meet in rare
    shingles give all their links, crowds a spanning forest of theirs.
    """
    context = texts.sparkSession.sparkContext
    frequent = context.broadcast(frequent_shingles(counts, most).tobytes())
    prefixes = texts.mapInArrow(
        _prefixes(frequent, rule, orders), "turn int, token long, often boolean, node long, n long"
    )
    met = meetings(prefixes, rule, paired)
    crowd = met.filter("crowded").select(F.col("turn").cast("int"), F.col("a").alias("token"), F.col("b").alias("node"))
    pairs = written(candidate_pairs(met, crowd, orders), "candidate-pairs")
    stars = pairs.select(F.col("a").alias("lead"), F.col("b").alias("node")).union(pairs.select("a", "a").distinct())
    units = written(
        stars.select("lead", F.lit(-1).alias("i"), F.lit(-1).alias("j"), "node").unionByName(crowded_blocks(crowd, block)),
        "join-units",
    )
    bitmap = context.broadcast(_bitmap(units))
    wanted = texts.mapInArrow(_wanted_texts(bitmap, rule.width), "node long, text binary")
    work = units.join(wanted, "node").select("lead", "i", "j", "node", "text")
    laid = work.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j")
    return laid.mapInArrow(_verifying(rule), "a long, b long")


def _mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def join_components(documents: DataFrame, rule: Rule = Rule(), orders: int = ORDERS, most: int = FREQUENT, paired: int = PAIRED, block: int = BLOCK) -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles, root (of the component) and component_id of every row."""
    source = documents.select(F.col("doc_id").alias("id"), _mark().alias("mark"), F.coalesce("text", F.lit("")).alias("text"))
    survey = written(source.mapInArrow(_survey(rule.width), "id long, mark long, n long, node long, token long"), "survey")
    members, counts = survey.filter("token IS NULL"), survey.filter("token IS NOT NULL").select("token", "n")
    roots = components(links(source.select("text"), counts, rule, orders, most, paired, block))
    classes = members.filter("n > 0").groupBy("node").agg(F.min("id").alias("least")).join(roots, "node", "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    lowest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = classes.join(lowest, "root").select("node", "root", "component_id")
    return members.join(by_node, "node", "left").select(
        F.col("id").alias("doc_id"),
        "mark",
        F.col("n").alias("n_shingles"),
        "root",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def one_of_each(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The documents without all but the one of smallest id of each component.

    A null id counts as the largest; of rows with that id the one with the smallest hash of
    its text stays, of equal rows one. Documents without words all stay.

    Most rows stay and need not move: a filter of bounded size over the rows in question
    tells them. Only what does not pass it is joined, by id and hash of the text.
    """
    columns = documents.columns
    found = written(join_components(documents.select("doc_id", "text"), rule).filter("n_shingles > 0"), "components")
    key = F.struct("doc_id", "mark")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    staying = found.groupBy("root").agg(F.min(first).alias("row")).select(
        "root", F.struct("row.doc_id", "row.mark").alias("_key")
    )
    rows_of_key = found.groupBy("root", "doc_id", "mark").count()
    in_question = rows_of_key.join(staying, "root").filter((key != F.col("_key")) | (F.col("count") > 1))
    words = _bit_words(in_question.select(F.xxhash64("doc_id", "mark").alias("node")))

    mark = _mark()
    rows = documents.select(
        F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)]).alias("_row"),
        F.struct("doc_id", mark.alias("mark")).alias("_key"),
        F.xxhash64("doc_id", mark).alias("node"),
        F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    ).withColumn("word", _word_of("node"))
    # at most 2 ** 20 rows of two numbers
    marked = rows.join(F.broadcast(words), "word", "left").withColumn("bit", _place_of("node"))
    asked = F.expr("worded AND coalesce(shiftright(bits, bit) & 1, 0) = 1")
    checked = marked.filter(asked).join(staying.select("_key"), "_key", "left_semi").dropDuplicates(["_key"])
    kept = marked.filter(~asked).select("_row").unionByName(checked.select("_row"))
    return kept.select(*[F.col("_row")[f"c{k}"].alias(c) for k, c in enumerate(columns)])
