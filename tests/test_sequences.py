"""Random event sequences against plain loops, in any number of blocks."""

import random

import pytest
from tables import AS_OF, as_result, by_hand_all, day, ledger_row, make_inputs, product, shipment

from stockflow.plans.readiness import Horizon, event_totals, order_readiness, policy_differences


def _random_plan(seed, keys, events, hot_share=0.0):
    rng = random.Random(seed)
    names = [(f"PRD-{rng.randrange(1 + keys // 2)}", f"WH-{k}") for k in range(keys)]
    stock = {key: rng.randint(-20, 120) for key in names if rng.random() < 0.8}
    safety = {key[0]: rng.randint(0, 30) for key in names if rng.random() < 0.8}
    planned = []
    for i in range(events):
        key = names[0] if rng.random() < hot_share else rng.choice(names)
        direction = "I" if rng.random() < 0.45 else "O"
        planned.append((key, (rng.randint(1, 25), direction, rng.randint(1, 60), f"S{rng.randrange(10**6)}-{i}")))
    return stock, safety, planned


def _inputs(spark, stock, safety, planned):
    return make_inputs(
        spark,
        [product(name, s) for name, s in safety.items()] or [product("none")],
        [shipment(d, w, q, i, key) for key, (d, w, q, i) in planned],
        [ledger_row(f"T{n}", q, key=key) for n, (key, q) in enumerate(stock.items())] or [ledger_row("T", 0)],
    )


def _expected(stock, safety, planned, policy):
    dated = [(key, (day(d), w, q, i)) for key, (d, w, q, i) in planned]
    return by_hand_all(stock, safety, dated, policy)


@pytest.mark.parametrize("policy", ["netted", "clamped"])
@pytest.mark.parametrize("seed", [1, 2])
def test_many_keys_match_the_loop(spark, seed, policy):
    plan = _random_plan(seed, keys=40, events=600)
    result = order_readiness(_inputs(spark, *plan), Horizon(AS_OF, 9), policy)
    assert as_result(result) == _expected(*plan, policy)


@pytest.mark.parametrize("policy", ["netted", "clamped"])
@pytest.mark.parametrize("blocks", [1, 2, 7, 64])
def test_half_of_the_events_in_one_key(spark, blocks, policy):
    plan = _random_plan(7, keys=12, events=800, hot_share=0.5)
    inputs = _inputs(spark, *plan)
    sizes = event_totals(inputs, Horizon(AS_OF, blocks)).groupBy("block", "product_id", "warehouse_id").count().collect()
    largest = max(r["count"] for r in sizes)
    assert sum(r["count"] for r in sizes) == 800 and (largest > 400 if blocks == 1 else largest < 2000 / blocks)
    assert as_result(order_readiness(inputs, Horizon(AS_OF, blocks), policy)) == _expected(*plan, policy)


def test_one_day_of_one_key_is_spread_too(spark):
    """All events on one date and in one direction: only the ids tell them apart."""
    planned = [(("PRD-1", "WH-1"), (3, "O", 1, f"S{i:05d}")) for i in range(500)]
    plan = ({("PRD-1", "WH-1"): 120}, {"PRD-1": 5}, planned)
    inputs = _inputs(spark, *plan)
    sizes = event_totals(inputs, Horizon(AS_OF, 20)).groupBy("block").count().collect()
    assert max(r["count"] for r in sizes) <= 50
    assert as_result(order_readiness(inputs, Horizon(AS_OF, 20))) == _expected(*plan, "netted")


def test_blocks_come_from_the_session_and_not_from_the_data(spark):
    """No job runs over the raw schedule to choose a layout: all sizes are laid out alike."""
    for events in (5, 400):
        inputs = _inputs(spark, *_random_plan(3, keys=5, events=events))
        totals = event_totals(inputs, Horizon(AS_OF))
        assert totals.agg({"block": "max"}).first()[0] < int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("policy", ["netted", "clamped"])
def test_many_short_orders_and_arrival_days(spark, policy):
    """One key with many short orders and days of arrivals."""
    planned = [(("P", "W"), (d, "I", 30, f"I{d:05d}")) for d in range(1, 300)]
    planned += [(("P", "W"), (1 + i % 7, "O", 1 + i % 40, f"O{i:05d}")) for i in range(900)]
    plan = ({("P", "W"): 0}, {}, planned)
    assert as_result(order_readiness(_inputs(spark, *plan), Horizon(AS_OF, 8), policy)) == _expected(*plan, policy)


def test_no_events_at_all(spark):
    inputs = make_inputs(spark, [product()], [shipment(-1, "O", 5, "old")], [ledger_row("t", 5)])
    for blocks in (None, 3):
        assert order_readiness(inputs, Horizon(AS_OF, blocks)).count() == 0
        assert policy_differences(inputs, Horizon(AS_OF, blocks)).count() == 0


def test_policy_differences_are_those_of_the_two_tables(spark):
    inputs = _inputs(spark, *_random_plan(11, keys=20, events=400))
    horizon = Horizon(AS_OF, 5)
    one, other = (as_result(order_readiness(inputs, horizon, p)) for p in ("netted", "clamped"))
    differ = {name for name in one if (one[name][2:]) != (other[name][2:])}
    assert {r["shipment_id"] for r in policy_differences(inputs, horizon).collect()} == differ and differ
