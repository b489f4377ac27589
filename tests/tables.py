"""Small input tables from short notations, and the readiness rules as a plain loop."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, timedelta
from itertools import accumulate, islice

from stockflow import contract
from stockflow.plans.readiness import Inputs

AS_OF = date(2026, 8, 1)
KEY = ("PRD-1", "WH-EAST")


def day(offset: int) -> date:
    return AS_OF + timedelta(days=offset)


def shipment(offset, direction, planned, name, key=KEY, status="SCHEDULED"):
    kind = {"I": "INBOUND", "O": "OUTBOUND"}.get(direction, direction)
    when = None if offset is None else day(offset)
    return (name, *key, when, planned, None, kind, status)


def ledger_row(name, quantity, offset=0, key=KEY, kind="ADJUSTMENT"):
    when = None if offset is None else day(offset)
    return (name, None, *key, when, kind, quantity, "A", "B")


def product(name="PRD-1", safety=0):
    return (name, "Food", "Bags", 36, "Secure", safety)


def make_inputs(spark, products, shipments, ledger, keep_null_keys=False) -> Inputs:
    return Inputs(
        spark.createDataFrame(products, contract.PRODUCT_SCHEMA),
        spark.createDataFrame(shipments, contract.SHIPMENT_SCHEMA),
        spark.createDataFrame(ledger, contract.TRANSACTION_SCHEMA),
        keep_null_keys,
    )


def _levels(moves, opening):
    """What each event finds, per policy: the debt is kept (netted) or written off (clamped)."""
    owing = [*accumulate(moves, initial=opening)]
    dropped = [*accumulate(moves, lambda held, x: max(held + x, 0), initial=opening)]
    return {"netted": [max(x, 0) for x in owing[:-1]], "clamped": dropped[:-1]}


def _netted_cover(events, found, k):
    """The earliest arrival of a later date after which the order's whole quantity is there."""
    when, _, planned, _ = events[k]
    enough = [e[0] for e, held in zip(events, found) if e[1] == "I" and e[0] > when and held + e[2] >= planned]
    return min(enough, default=None)


def _clamped_cover(events, found, moves, k):
    """The first event from which on what came in since, on top of what was there, is enough."""
    reached = accumulate(moves[k + 1 :], initial=found[k])
    later = zip(islice(reached, 1, None), events[k + 1 :])
    return next((e[0] for total, e in later if total >= events[k][2]), None)


def by_hand(stock, safety, events, policy):
    """{order id: (available, after, missing, status, earliest)} for the events of one key.

    `events` are (date, direction, planned, id).
    """
    events = sorted(events, key=lambda e: (e[0], e[1] != "I", e[3]))
    moves = [planned if way == "I" else -planned for _, way, planned, _ in events]
    found = _levels(moves, max(stock, 0))[policy]
    result = {}
    for k, (when, way, planned, name) in enumerate(events):
        if way != "I":
            gap, left = max(planned - found[k], 0), max(found[k] - planned, 0)
            cover = _netted_cover(events, found, k) if policy == "netted" else _clamped_cover(events, found, moves, k)
            filled = {True: "AT_RISK", False: "READY"}[left < safety], when
            short = {True: "SHORT", False: "WAITING_FOR_INBOUND"}[cover is None], cover
            result[name] = (found[k], left, gap, *(short if gap else filled))
    return result


def by_hand_all(stock, safety, events, policy):
    """The same for events of many keys: {key: stock}, {product: safety}, [(key, event)]."""
    grouped = defaultdict(list)
    for key, event in events:
        grouped[key].append(event)
    result = {}
    for key, own in grouped.items():
        result.update(by_hand(stock.get(key, 0), safety.get(key[0], 0), own, policy))
    return result


def as_result(readiness):
    return {
        r["shipment_id"]: (
            r["available_before_order"],
            r["projected_inventory_after_order"],
            r["missing_pallets"],
            r["readiness_status"],
            r["earliest_available_date"],
        )
        for r in readiness.collect()
    }
