"""Repaired conversations against all edits tried one by one."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from stockflow.llm import conversations
from stockflow.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    """(role, text, fault letter) in order, read row by row."""
    seen, out = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "b"
        elif (role, text) in seen:
            fault = "d"
        else:
            fault = "t" if re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows): Dijkstra over (rows used, rows made), all edits anywhere."""
    rows = faults(rows)
    heap, done = [(0, "", 0, ())], set()
    while heap:
        cost, audit, used, made = heapq.heappop(heap)
        initials = "".join(role[:1] for role, _ in made)
        if used == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, made
        last = initials[-1:] if len(initials) < 2 or initials[0] != "s" else initials[-1]
        key = (used, last)
        if (key, "closed") in done:
            continue
        done.add((key, "closed"))
        wanted = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[wanted]
        heapq.heappush(heap, (cost + 5, audit + "I", used, (*made, (name, ""))))
        if used < len(rows):
            role, text, fault = rows[used]
            heapq.heappush(heap, (cost + 2, audit + "D", used + 1, made))
            if fault not in ("b", "d"):
                stay = 5 if fault == "t" else 0
                if role[:1] == wanted or (role[:1] == "s" and not made):
                    heapq.heappush(heap, (cost + stay, audit + "K", used + 1, (*made, (role, text))))
                heapq.heappush(heap, (cost + stay + 1, audit + "R", used + 1, (*made, (name, text))))
    raise AssertionError


def summary(rows):
    """The expected row of a conversation from its (turn, role, text)."""
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    marked = [f for _, _, f in faults([r[1:] for r in rows])]
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[1][:1] for r in rows]
    cost, audit, made = cheapest([r[1:] for r in rows])
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[marked.count(f) for f in "bdt"],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
    )


def expected(rows):
    """Every conversation's row: damaged one by one, then repaired."""
    by_id = {}
    for conv, turn, role, text in rows:
        own = by_id.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(repr((conv, *summary(own))) for conv, own in by_id.items())


def random_conversation(rng, conv, n, odd=0.3):
    roles = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * n
    rows = []
    for turn, role in enumerate(roles[:n]):
        if rng.random() < odd:
            role = rng.choice(["user", "assistant", "system", "tool", "", "A", None])
        text = rng.choice(["Hi.", "Yes!", "no end", "é 中?\n", "", "\t \x0b", None, "same."]) if rng.random() < 2 * odd else f"text {rng.random()}."
        rows.append((conv, rng.choice([turn, turn, turn + 1, None]) if rng.random() < odd else turn, role, text))
    return rows


def found(spark, rows):
    table = damaged(spark.createDataFrame(rows, SCHEMA).repartition(4))
    return sorted(repr(tuple(r)) for r in conversations.repair(table, present="present").collect())


@pytest.mark.parametrize("odd", [0.05, 0.3, 0.9])
def test_edits_are_the_cheapest_and_least(spark, odd):
    rng = random.Random(int(odd * 100))
    rows = [row for conv in range(300) for row in random_conversation(rng, conv, rng.randrange(12), odd)]
    assert found(spark, rows) == expected(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", "."),
        (2, 0, "user", "Same."), (2, 0, "user", "Same."), (2, 5, "user", "Same."), (2, 5, "assistant", "Other."),
        (3, -4, "system", "x" * 200_000), (4, 1 << 40, "a", "!"), (4, 0, "u", "?"), (5, 0, "", ""),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []


def test_a_conversation_of_which_nothing_is_left(spark):
    name = next(k for k in range(10_000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(name, 0, "user", "Hi.")]) == [repr((name, 0, 0, 0, 0, 0, 0, "", empty))]


def test_columns_of_any_name(spark):
    rng = random.Random(9)
    rows = [row for conv in range(20) for row in random_conversation(rng, conv, 6)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS fault", "2 AS seen", "3 AS mark", "4 AS audit", "5 AS place")
    own = sorted(repr(tuple(r)) for r in conversations.repair(damaged(table), present="present").collect())
    assert own == expected(rows)


def test_repaired_rows_have_the_digest_of_the_summary(spark):
    rng = random.Random(10)
    rows = [row for conv in range(60) for row in random_conversation(rng, conv, 9, 0.5)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    lines = {}
    for r in sorted(conversations.repaired_rows(table).collect(), key=lambda r: (r.conv_id, r.place)):
        assert r.edit in "KRI" and (r.edit != "I" or (r.turn is None and r.text == ""))
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in conversations.repair(table).collect():
        assert hashlib.sha256("\n".join(lines.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256
        assert len(r.audit.replace("D", "")) == len(lines.get(r.conv_id, []))


def test_tree_stays_small_where_survivors_coalesce():
    rng = random.Random(11)
    audit, most = [], 0
    decoder = conversations.Decoder(audit.append)
    for k in range(20_000):
        initial = "ua"[k % 2] if rng.random() < 0.97 else rng.choice("uasx")
        decoder.row(initial, rng.choice([0] * 30 + [1, 2, 3]), b"user:x", b":x")
        most = max(most, decoder.undecided)
    decoder.end()
    assert most < 2000 and len("".join(audit).replace("I", "")) == 20_000


def test_undecided_edits_are_compared_in_whole():
    """Only the last row tells which of two parallel survivors is right, from the first row on."""
    for n in (40, 41):
        rows = [("user", f"text {k}.") for k in range(n)]
        audit = []
        decoder = conversations.Decoder(audit.append)
        for role, text in rows:
            decoder.row(role[:1], 0, f"{role}:{text}".encode(), f":{text}".encode())
        cost, digest = decoder.end()
        want = cheapest(rows)
        assert (cost, "".join(audit)) == want[:2]
        assert digest == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in want[2]).encode()).hexdigest()
