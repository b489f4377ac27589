"""Hand-worked cases, one rule each."""

import pytest
from tables import AS_OF, KEY, as_result, day, ledger_row, make_inputs, product, shipment

from stockflow import contract
from stockflow.operators.events import overdue_open_shipments
from stockflow.plans.readiness import Horizon, order_readiness, policy_differences
from stockflow.sources.readers import read_table

READY, RISK, WAIT, SHORT = contract.READINESS_STATUSES

# name: stock, safety stock, events, netted result, clamped result (None: the same)
CASES = {
    "published_example": (
        20, 0, [(1, "O", 15, "a"), (2, "I", 10, "b"), (3, "O", 18, "c")],
        {"a": (20, 5, 0, READY, 1), "c": (15, 0, 3, SHORT, None)}, None,
    ),
    "policies_differ": (
        5, 0, [(1, "O", 10, "a"), (2, "I", 8, "b"), (3, "O", 6, "c")],
        {"a": (5, 0, 5, SHORT, None), "c": (3, 0, 3, SHORT, None)},
        {"a": (5, 0, 5, WAIT, 2), "c": (8, 2, 0, READY, 3)},
    ),
    "inbound_first_on_a_day": (
        0, 0, [(1, "O", 5, "a"), (1, "I", 5, "b")], {"a": (5, 0, 0, READY, 1)}, None,
    ),
    "risk_is_strictly_below_safety": (
        10, 6, [(1, "O", 4, "a"), (2, "O", 1, "b")],
        {"a": (10, 6, 0, READY, 1), "b": (6, 5, 0, RISK, 2)}, None,
    ),
    "negative_balance_is_zero": (-7, 0, [(1, "O", 1, "a")], {"a": (0, 0, 1, SHORT, None)}, None),
    "tie_by_id_text": (
        5, 0, [(1, "O", 3, "b"), (1, "O", 4, "a")],
        {"a": (5, 1, 0, READY, 1), "b": (1, 0, 2, SHORT, None)}, None,
    ),
    "cover_ignores_the_backlog": (
        0, 0, [(1, "O", 40, "a"), (2, "O", 5, "b"), (3, "I", 5, "c")],
        {"a": (0, 0, 40, SHORT, None), "b": (0, 0, 5, WAIT, 3)}, None,
    ),
    "own_demand_counts_twice_when_netted": (
        0, 0, [(1, "O", 10, "a"), (2, "I", 6, "b"), (3, "I", 6, "c")],
        {"a": (0, 0, 10, SHORT, None)}, {"a": (0, 0, 10, WAIT, 3)},
    ),
    "cover_on_the_same_day_is_no_cover": (
        0, 0, [(1, "O", 9, "a"), (1, "I", 5, "b")], {"a": (5, 0, 4, SHORT, None)}, None,
    ),
}


@pytest.mark.parametrize("blocks", [1, 5])
@pytest.mark.parametrize("policy", ["netted", "clamped"])
def test_hand_worked_cases(spark, policy, blocks):
    products, shipments, ledger, expected = [], [], [], {}
    for name, (stock, safety, events, netted, clamped) in CASES.items():
        key = (name, "WH-EAST")
        products.append(product(name, safety))
        ledger.append(ledger_row(f"tx-{name}", stock, key=key))
        shipments += [shipment(d, w, q, f"{name}-{i}", key) for d, w, q, i in events]
        for i, (before, after, missing, status, earliest) in (
            netted if policy == "netted" or clamped is None else clamped
        ).items():
            expected[f"{name}-{i}"] = (before, after, missing, status, earliest and day(earliest))
    inputs = make_inputs(spark, products, shipments, ledger)
    horizon = Horizon(AS_OF, blocks)
    assert as_result(order_readiness(inputs, horizon, policy)) == expected


def test_policy_differences_lists_only_changed_orders(spark):
    events = [shipment(d, w, q, i) for d, w, q, i in CASES["policies_differ"][2]]
    same = [shipment(1, "O", 1, "z", ("PRD-2", "WH-EAST"))]
    inputs = make_inputs(spark, [product()], events + same, [ledger_row("t", 5)])
    rows = policy_differences(inputs, Horizon(AS_OF, 2)).collect()
    assert {r["shipment_id"] for r in rows} == {"a", "c"}


def _ready(spark, shipments, ledger=(), products=(), policy="netted", **kwargs):
    ledger = list(ledger) or [ledger_row("none", 0)]
    products = list(products) or [product()]
    inputs = make_inputs(spark, products, shipments, ledger, **kwargs)
    return as_result(order_readiness(inputs, Horizon(AS_OF, 2), policy))


def test_ledger_counts_up_to_and_including_as_of(spark):
    result = _ready(spark, [shipment(1, "O", 9, "a")], [ledger_row("t1", 4, 0), ledger_row("t2", 100, 1)])
    assert result["a"][0] == 4


def test_only_shipments_after_as_of_are_evaluated(spark):
    assert set(_ready(spark, [shipment(0, "O", 9, "now"), shipment(1, "O", 9, "next")])) == {"next"}


def test_planned_quantity_limits(spark):
    rows = [shipment(1, "O", q, f"q{q}") for q in (0, 1, 500, 501, None)]
    inputs = make_inputs(spark, [product()], rows, [ledger_row("t", 0)])
    assert {r["shipment_id"] for r in inputs.shipments().collect()} == {"q1", "q500"}
    assert {r["shipment_id"] for r in inputs.rejected_shipments().collect()} == {"q0", "q501", "qNone"}


def test_ledger_quantity_limits(spark):
    values = (-501, -500, 0, 500, 501, None, -(2**31))
    rows = [ledger_row(f"t{v}", v) for v in values]
    inputs = make_inputs(spark, [product()], [shipment(1, "O", 1, "a")], rows)
    assert {r["transaction_id"] for r in inputs.transactions().collect()} == {"t-500", "t0", "t500"}
    assert inputs.rejected_transactions().count() == 4


def test_unknown_or_missing_enums_are_rejected(spark):
    rows = [shipment(1, "inbound", 5, "lower"), shipment(1, None, 5, "null"), shipment(1, "O", 5, "ok")]
    rows += [shipment(1, "O", 5, "status", status="LOST"), shipment(None, "O", 5, "undated")]
    inputs = make_inputs(spark, [product()], rows, [ledger_row("t", 0)])
    assert [r["shipment_id"] for r in inputs.shipments().collect()] == ["ok"]
    assert inputs.rejected_shipments().count() == 4


def test_cancelled_is_ignored_and_delayed_counts_on_its_date(spark):
    rows = [shipment(1, "I", 50, "x", status="CANCELLED"), shipment(2, "O", 5, "a")]
    assert _ready(spark, rows)["a"][2] == 5
    rows = [shipment(1, "I", 50, "x", status="DELAYED"), shipment(2, "O", 5, "a")]
    assert _ready(spark, rows)["a"][2] == 0


def test_overdue_open_shipments_are_reported_but_not_projected(spark):
    rows = [
        shipment(0, "I", 50, "d", status="DELAYED"),
        shipment(-3, "I", 50, "s"),
        shipment(-3, "I", 50, "c", status="COMPLETED"),
        shipment(2, "O", 5, "a"),
    ]
    inputs = make_inputs(spark, [product()], rows, [ledger_row("t", 0)])
    found = overdue_open_shipments(inputs.shipments(), AS_OF).collect()
    assert {r["shipment_id"] for r in found} == {"d", "s"}
    assert _ready(spark, rows)["a"][2] == 5


def test_unknown_product_and_key_without_ledger(spark):
    rows = [shipment(1, "O", 5, "a", ("PRD-9", "WH-WEST")), shipment(1, "O", 5, "b", KEY)]
    result = _ready(spark, rows, [ledger_row("t", 5)], [product("PRD-1", safety=3)])
    assert result["a"] == (0, 0, 5, SHORT, None)
    assert result["b"] == (5, 0, 0, RISK, day(1))


def test_null_keys_collapse_or_stay(spark):
    rows = [shipment(1, "O", q, None) for q in (1, 2, 3)] + [shipment(1, "O", 1, "a")]
    ledger = [ledger_row("t", 0)]
    assert make_inputs(spark, [product()], rows, ledger).rejected_shipments().count() == 1
    kept = make_inputs(spark, [product()], rows, ledger, keep_null_keys=True)
    assert kept.rejected_shipments().count() == 3
    assert kept.shipments().count() == 1


def test_conflicting_copies_keep_the_first_by_all_columns(spark):
    rows = [
        shipment(2, "O", 7, "a"),
        shipment(1, "O", 9, "a"),
        shipment(1, "O", 8, "a"),
        shipment(None, "O", 1, "a"),
    ]
    inputs = make_inputs(spark, [product()], rows, [ledger_row("t", 0)])
    kept = inputs.deduped_shipments().collect()
    assert [(r["scheduled_date"], r["planned_pallet_quantity"]) for r in kept] == [(day(1), 8)]


def test_unreadable_csv_cells_become_null(spark, tmp_path):
    file = tmp_path / "shipment_schedule.csv"
    file.write_text(
        "shipment_id,product_id,warehouse_id,scheduled_date,planned_pallet_quantity,"
        "actual_pallet_quantity,shipment_type,shipment_status\n"
        "good,P,W,2026-08-04,4,,INBOUND,SCHEDULED\n"
        "date,P,W,2026-13-45,4,,INBOUND,SCHEDULED\n"
        "text,P,W,2026-08-04,abc,,INBOUND,SCHEDULED\n"
        "point,P,W,2026-08-04,4.0,,INBOUND,SCHEDULED\n"
        "short,P,W,2026-08-04\n"
    )
    table = read_table(spark, str(file), contract.SHIPMENT_SCHEMA, "csv")
    rows = {r["shipment_id"]: r for r in table.collect()}
    assert rows["good"]["planned_pallet_quantity"] == 4
    assert rows["date"]["scheduled_date"] is None and rows["date"]["planned_pallet_quantity"] == 4
    for name in ("text", "point", "short"):
        assert rows[name]["planned_pallet_quantity"] is None
    assert rows["short"]["shipment_status"] is None


def test_wrong_arguments_are_refused(spark):
    inputs = make_inputs(spark, [product()], [shipment(1, "O", 1, "a")], [ledger_row("t", 0)])
    with pytest.raises(ValueError):
        order_readiness(inputs, Horizon("2026-13-01"))
    with pytest.raises(ValueError):
        order_readiness(inputs, Horizon(AS_OF, 2), "hopeful")
    with pytest.raises(ValueError):
        read_table(spark, "/nowhere", contract.PRODUCT_SCHEMA, "xlsx")
