"""Conversations brought back to turns by user and assistant, with the cheapest edits.

A row's first fault counts: blank (nothing but white space), duplicate (role and text seen
earlier in the conversation), truncated (the last character that is not white space is none of
`.!?`). Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2 (the only one for blank and
duplicate rows), Insert of an empty user or assistant row 5; a truncated row that stays adds 5.
The roles' initials of what is left are `(s?(ua)+)?`. Of equally cheap edits those with the
smallest audit count: the initials of the edits, in order, compared as text.

Survivor-coalescence Viterbi. The states are what the repaired rows end with: nothing, system,
user, assistant. Each state keeps one survivor, its cheapest edits so far. Their edits are
paths in a tree of back pointers with a count of the children of each node. A node that no
survivor comes from any more is freed, and while the root has one child only, that child's
edits are decided and leave the tree. Ties compare the whole undecided suffixes: survivors
carry the order of these along, which extending them can only refine, as no audit that ends
with a row's edit is the beginning of another one of the same rows. A survivor goes as soon as
another one could imitate all it may still become at less cost; that lets the others coalesce.
What is held is the undecided part of the tree, and of the repaired rows a running digest
for each survivor, not their texts.

Inserting before a deletion is never tried: the deletion first is as cheap and has the smaller
audit. Nor are two insertions in a row: they lead to where the survivor was.

Scale: one shuffle by conversation. Repeats are found by a window, which spills, and rows reach
the decoder as a sorted stream, so no conversation is held in memory. One conversation is read
by one task: a SHA-256 of all its repaired rows can only be computed in their order.

Defined cases: null roles and texts are one space; rows come by turn (null first), then role and
text. A null conversation id is a conversation of its own. Rows that `present` marks as gone
only name their conversation; one without any other rows has zeros, an empty audit and the
digest of nothing. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SYSTEM, USER, ASSISTANT = range(4)
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)

REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5

# the role that follows each state, but for a system row at the start
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {"su", "ua", "au"}

# what it costs at most to do from the first state whatever can follow the second
IMITATE = {
    (ASSISTANT, START): DELETE, (USER, START): INSERT + DELETE, (SYSTEM, START): 2 * INSERT,
    (START, SYSTEM): 0, (ASSISTANT, SYSTEM): 0, (USER, SYSTEM): INSERT,
    (START, USER): INSERT, (SYSTEM, USER): INSERT, (ASSISTANT, USER): INSERT,
    (START, ASSISTANT): 0, (USER, ASSISTANT): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT,
}


def _moves(initial: int | None, fault: int) -> dict[int, list[tuple[int, str, int]]]:
    """For each state: (cost, edits, state after) of a row, insertions before it included."""
    moves = {state: [(DELETE, "D", state)] for state in range(4)}
    if fault in (BLANK, DUPLICATE):
        return moves
    cut = CUT if fault == TRUNCATED else 0
    for state, own in moves.items():
        for insert, before, here in ((0, "", state), (INSERT, "I", NEXT[state])):
            role = NEXT[here]
            own.append((insert + cut, before + "K", role) if initial == role else (insert + cut + REROLE, before + "R", role))
        if state == START and initial == SYSTEM:
            own.append((cut, "K", SYSTEM))
    return moves


MOVES = {(i, f): _moves(i, f) for i in (None, SYSTEM, USER, ASSISTANT) for f in range(4)}


class Decoder:
    """One conversation. `decided` gets the edits of row after row, as soon as they are certain."""

    def __init__(self, decided: Callable[[str], None], digests: bool = True) -> None:
        self.decided = decided
        # per state: cost, place of its edits in the order of all survivors' edits, node, digest
        self.survivors = {START: (0, 0, 0, hashlib.sha256() if digests else None)}
        self.root = 0
        self.parent, self.edits, self.children, self.mixed = [0], [""], [0], [0]
        self.free: list[int] = []

    @property
    def undecided(self) -> int:
        return len(self.parent) - len(self.free)

    def row(self, initial: str, fault: int, line: bytes, text: bytes) -> None:
        """The next row: its role's initial, fault, `role:text` and `:text`."""
        moves = MOVES[INITIAL.get(initial), fault]
        best: dict[int, tuple] = {}
        for state, (cost, order, _, _) in self.survivors.items():
            for more, edits, after in moves[state]:
                found = (cost + more, order, edits, state)
                if after not in best or found < best[after]:
                    best[after] = found
        kept = [
            (order, edits, cost, state, after)
            for after, (cost, order, edits, state) in best.items()
            if not any(x[0] + IMITATE[s, after] < cost for s, x in best.items() if s != after)
        ]
        survivors = {}
        for place, (_, edits, cost, state, after) in enumerate(sorted(kept)):
            _, _, node, digest = self.survivors[state]
            survivors[after] = (cost, place, self._child(node, edits), self._extended(digest, edits, state, line, text))
        old, self.survivors = self.survivors, survivors
        for _, _, node, _ in old.values():
            self._release(node)
        self._coalesce()

    def end(self) -> tuple[int, str]:
        """(cost, SHA-256 of the repaired rows); the last edits are decided."""
        last = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        ends = [(x[0] + INSERT * len(last[s]), x[1], s) for s, x in self.survivors.items()]
        cost, _, state = min(ends)
        _, _, node, digest = self.survivors[state]
        path = [last[state]] if last[state] else []
        while node != self.root:
            path.append(self.edits[node])
            node = self.parent[node]
        for edits in reversed(path):
            self.decided(edits)
        digest = self._extended(digest, last[state], state, b"", b"")
        return cost, digest.hexdigest() if digest else ""

    def _extended(self, digest, edits: str, state: int, line: bytes, text: bytes):
        if digest is None or edits in ("", "D"):
            return digest
        digest = digest.copy()
        for edit in edits:
            own = line if edit == "K" else ROLE[NEXT[state]].encode() + (text if edit == "R" else b":")
            digest.update(own if state == START else b"\n" + own)
            state = SYSTEM if edit == "K" and state == START and line[:1] == b"s" else NEXT[state]
        return digest

    def _child(self, parent: int, edits: str) -> int:
        if self.free:
            node = self.free.pop()
            self.parent[node], self.edits[node], self.children[node], self.mixed[node] = parent, edits, 0, 0
        else:
            node = len(self.parent)
            for column, value in zip((self.parent, self.edits, self.children, self.mixed), (parent, edits, 0, 0)):
                column.append(value)
        self.children[parent] += 1
        # the exclusive or of its children names the child of a node that has one
        self.mixed[parent] ^= node
        return node

    def _release(self, node: int) -> None:
        while node != self.root and not self.children[node]:
            parent = self.parent[node]
            self.children[parent] -= 1
            self.mixed[parent] ^= node
            self.free.append(node)
            node = parent

    def _coalesce(self) -> None:
        while self.children[self.root] == 1:
            child = self.mixed[self.root]
            self.decided(self.edits[child])
            self.free.append(self.root)
            self.root = child


def _faults(present: Column) -> Column:
    return (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(F.col("seen") > 1, DUPLICATE)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED)
        .otherwise(SOUND)
    )


def ordered_rows(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None
) -> DataFrame:
    """(conv_id, turn, role, text, fault, present), conversations side by side and in order."""
    own = rows.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.coalesce(F.col(present), F.lit(False)).alias("present") if present else F.lit(True).alias("present"),
    ).repartition("conv_id")
    alike = Window.partitionBy("conv_id", "present", "role", "mark").orderBy(F.col("turn").asc_nulls_first())
    return (
        own.withColumn("mark", F.md5("text"))
        .withColumn("seen", F.row_number().over(alike))
        .withColumn("fault", _faults(F.col("present")))
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen")
        .select("conv_id", "turn", "role", "text", "fault", "present")
    )


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


class _Summary:
    """What is counted of one conversation beside its edits."""

    def __init__(self, conversation) -> None:
        self.conversation = conversation
        self.audit: list[str] = []
        self.decoder = Decoder(self.audit.append)
        self.counts = [0, 0, 0, 0]
        self.low = self.high = self.initial = None
        self.turns = self.illegal = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        self.counts[fault] += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        tail = b":" + text.encode()
        self.decoder.row(self.initial, fault, role.encode() + tail, tail)

    def line(self) -> tuple:
        cost, digest = self.decoder.end()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = [self.counts[fault] for fault in (BLANK, DUPLICATE, TRUNCATED)]
        return (self.conversation, gaps, *counts, self.illegal, cost, "".join(self.audit), digest)


SUMMARY = ["gaps bigint", "blank bigint", "duplicate bigint", "truncated bigint", "illegal bigint", "cost bigint", "audit string", "repaired_sha256 string"]
AT_ONCE = 1024


def _summaries(batches: Iterator[pa.RecordBatch], types: pa.Schema) -> Iterator[pa.RecordBatch]:
    def batch(lines: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), types.types)], schema=types)

    current, lines = None, []
    for conversation, turn, role, text, fault, present in _rows_of(batches):
        if current is None or current.conversation != conversation:
            if current is not None:
                lines.append(current.line())
            current = _Summary(conversation)
            if len(lines) == AT_ONCE:
                yield batch(lines)
                lines = []
        if present:
            current.add(turn, role, text, fault)
    if current is not None:
        lines.append(current.line())
        yield batch(lines)


def repair(rows: DataFrame, **columns: str) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the digest of the result."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ordered = ordered_rows(rows, **columns)
    schema = ordered.select("conv_id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in SUMMARY]).schema
    found = ordered.mapInArrow(partial(_summaries, types=to_arrow_schema(schema)), schema)
    return found.withColumnRenamed("conv_id", columns.get("conversation", "conv_id"))


class _Rewriter:
    """The repaired rows of one conversation; a row's text is held until its edits are decided."""

    def __init__(self, conversation) -> None:
        self.conversation = conversation
        self.rows: deque[tuple] = deque()
        self.out: list[tuple] = []
        self.state, self.place = START, 0
        self.decoder = Decoder(self.decided, digests=False)

    def add(self, turn, role: str, text: str, fault: int) -> None:
        self.rows.append((turn, role, text))
        self.decoder.row(role[:1], fault, b"", b"")

    def decided(self, edits: str) -> None:
        for edit in edits:
            turn, role, text = (None, None, "") if edit == "I" else self.rows.popleft()
            if edit == "D":
                continue
            system = edit == "K" and self.state == START and role[:1] == "s"
            self.state = SYSTEM if system else NEXT[self.state]
            self.out.append((self.conversation, self.place, turn, role if edit == "K" else ROLE[self.state], text, edit))
            self.place += 1


def _rewritten(batches: Iterator[pa.RecordBatch], types: pa.Schema) -> Iterator[pa.RecordBatch]:
    def batch(lines: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), types.types)], schema=types)

    current = None
    for conversation, turn, role, text, fault, present in _rows_of(batches):
        if current is None or current.conversation != conversation:
            if current is not None:
                current.decoder.end()
                if current.out:
                    yield batch(current.out)
            current = _Rewriter(conversation)
        if present:
            current.add(turn, role, text, fault)
            if len(current.out) >= AT_ONCE:
                yield batch(current.out)
                current.out = []
    if current is not None:
        current.decoder.end()
        if current.out:
            yield batch(current.out)


def repaired_rows(rows: DataFrame, **columns: str) -> DataFrame:
    """The repaired conversations: (conv_id, place, turn, role, text, edit), inserted rows without a turn."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ordered = ordered_rows(rows, **columns)
    schema = ordered.selectExpr("conv_id", "0L AS place", "turn", "role", "text", "'' AS edit").schema
    for field in schema.fields:
        field.nullable = True
    found = ordered.mapInArrow(partial(_rewritten, types=to_arrow_schema(schema)), schema)
    return found.withColumnRenamed("conv_id", columns.get("conversation", "conv_id"))
