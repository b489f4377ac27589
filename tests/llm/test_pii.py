"""Pseudonyms: permutations within a format, and back again."""

import hashlib
import hmac
import random

import pytest
from fixtures import ODD_ROWS, clashing, frame

from stockflow.llm import pii

VALUES = [
    "jane.doe+x@mail.example.org",
    "THE.72@MAIL3.EXAMPLE.COM",
    "+1 (017) 555-7713",
    "(212) 555-1234",
    "+49 30 1234 5678",
    "4111 1111 1111 1111",
    "4952935900253052",
    "4845168114407329",
    "3782-822463-10005",
    "123-45-6789",
    "169.122.221.182",
    "2024-02-29",
    "12/31/1999",
    "31.12.1999",
    "1/5/2024",
    "01/5/2024",
    "12/5/2024",
    "7.11.1980",
    "2024-3-05",
    "b44e15e09fd311c3cf3163b66d5a9875b883d8ce",
]
OTHERS = ["version 4.0.", "999.1.1.1", "30.02.2001", "13/13/2001", "1.2.3", "a@b", "12345", "GPL-3.0", "10:30"]
OTHERS += ["1234567890123456", "4111 1111 1111 1112", "000-00-0000", "666-12-1234", "900-12-1234", "123-00-1234", "123-45-0000"]
OTHERS += ["31/4/2024", "0/5/2024", "2024-03-05x", "2024-03-05Tea"]


def shape(text):
    return "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in text)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 1 << 16])
def test_every_size_is_permuted(size):
    network = pii.Feistel("key")
    values = range(min(size, 2000))
    images = [network.permuted(v, size, "p") for v in values]
    assert len(set(images)) == len(images) and all(0 <= x < size for x in images)
    assert [network.permuted(x, size, "p", True) for x in images] == list(values)


@pytest.mark.parametrize("bits", [32, 53, 64, 160])
def test_large_sizes_go_back(bits):
    network, rng = pii.Feistel("key"), random.Random(bits)
    for _ in range(50):
        value = rng.getrandbits(bits)
        image = network.permuted(value, 1 << bits, "p")
        assert image < 1 << bits and network.permuted(image, 1 << bits, "p", True) == value


@pytest.mark.parametrize("value", VALUES)
def test_values_keep_their_format_and_go_back(value):
    masker, back = pii.Masker("k"), pii.Masker("k", back=True)
    text = f"see {value}!! and {value}, end"
    new = masker.text(text, pii.found_in(text))
    assert value not in new and new != text
    assert back.text(new, pii.found_in(new)) == text
    assert new[4:].split("!!")[0] == new.split(" and ")[1].split(", end")[0]  # equal values stay equal
    if "." not in value or "@" in value:
        assert "e15" in value or shape(new) == shape(text)
    assert pii.Masker("other").text(text, pii.found_in(text)) != new


@pytest.mark.parametrize("other", OTHERS)
def test_what_is_no_value_stays(other):
    assert pii.found_in(f"x {other} y") == []


def test_card_numbers_keep_their_check_digit():
    masker, rng = pii.Masker(), random.Random(2)
    for _ in range(100):
        body = [str(rng.randrange(10)) for _ in range(15)]
        good = "".join([*body, str(pii.check_digit(body))])
        new = masker.card(good)
        assert len(new) == 16 and int(new[-1]) == pii.check_digit(list(new[:-1]))


def test_cards_are_read_by_their_writing():
    for text in ("4111 1111 1111 1111 123", "pay 4845168114407329 4111111111111111", "12 4111111111111111"):
        found = [(text[a:b], kind) for a, b, kind in pii.found_in(text)]
        assert found and all(kind == "card" and len(v.replace(" ", "")) == 16 for v, kind in found)


@pytest.mark.parametrize("stamp", ["T10:00:00Z", "T10", "T1000", "T100000+01:00"])
def test_the_day_of_a_time_stamp_is_replaced_and_its_time_stays(stamp):
    text = f"at 2024-03-05{stamp} and 2024-03-05."
    masker, back = pii.Masker("k"), pii.Masker("k", back=True)
    new = masker.text(text, pii.found_in(text))
    day = masker.date("2024-03-05")
    assert day != "2024-03-05" and new == f"at {day}{stamp} and {day}."
    assert back.text(new, pii.found_in(new)) == text


def test_national_numbers_are_permuted_among_valid_ones(monkeypatch):
    masker, back = pii.Masker("k"), pii.Masker("k", back=True)
    edge = ["001-01-0001", "665-99-9999", "667-01-0001", "899-99-9999"]
    rng = random.Random(5)
    for _ in range(300):
        area = rng.choice([a for a in range(1, 900) if a != 666])
        edge.append(f"{area:03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10_000):04d}")
    images = [masker.national(x) for x in edge]
    assert all(pii._national(x) for x in images) and len(set(images)) == len(set(edge))
    assert [back.national(x) for x in images] == edge
    # every number has a place of its own
    monkeypatch.setattr(pii.Masker, "_permuted", lambda self, value, size, purpose: value)
    assert [pii.Masker().national(x) for x in edge] == edge


def test_dates_keep_their_widths():
    masker, back = pii.Masker("k"), pii.Masker("k", back=True)
    for text in ("1/5/2024", "1/15/2024", "11/5/2024", "01/5/2024", "1/05/2024", "01/05/2024", "2024-3-5"):
        new = masker.date(text)
        assert shape(new) == shape(text) and back.date(new) == text and pii.read_date(new)
    assert len({masker.date(f"{m}/{d}/2024") for m in range(1, 10) for d in range(1, 10)}) == 81


def test_the_network_is_the_one_written_down():
    """Ten alternating additions of keyed digests to the halves, walked until inside."""
    size, right, left = 1000, 31, 33
    def turned(value):
        halves = list(divmod(value, right))
        for turn in range(10):
            own, other, below = (1, 0, right) if turn % 2 else (0, 1, left)
            message = f"p:{size}:{turn}:{halves[other]}".encode()
            digest = hmac.new(b"key", message, hashlib.sha512).digest()[: (below.bit_length() + 71) // 8]
            halves[own] = (halves[own] + int.from_bytes(digest, "big")) % below
        return halves[0] * right + halves[1]
    for value in range(size):
        image = turned(value)
        while image >= size:
            image = turned(image)
        assert pii.Feistel("key").permuted(value, size, "p") == image


def test_dates_stay_dates():
    masker = pii.Masker()
    for text in ("2024-02-29", "1900-01-01", "2099-12-31", "01/31/2000"):
        assert pii.read_date(masker.date(text)) is not None


def test_rows(spark):
    rows = [*ODD_ROWS, (70, f"call {VALUES[2]} or {VALUES[0]}", "en", "s"), (71, ", ".join(VALUES * 400), "en", "s")]
    table = clashing(frame(spark, rows))
    new = pii.pseudonymised(table)
    assert new.columns == table.columns
    plain = {repr(tuple(r)) for r in table.collect()}
    changed = [r for r in new.collect() if repr(tuple(r)) not in plain]
    assert len(changed) == 2 and new.count() == len(rows)
    found = {r.doc_id: r.n_found for r in pii.masked(frame(spark, rows)).collect()}
    assert found[70] == 2 and found[71] == 400 * len(VALUES) and found[1] == 0
    again = pii.unmasked(pii.masked(frame(spark, rows)).drop("n_found"))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, frame(spark, rows).collect()))
    assert pii.masked(frame(spark, [])).collect() == []
