"""First in, first out, pallet by pallet."""

import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F
from tables import AS_OF, day, ledger_row, make_inputs, product, shipment

from stockflow.operators.balance import current_inventory
from stockflow.operators.lots import OPENING, lot_matches
from stockflow.plans.readiness import Horizon, lot_matching, order_readiness, projected_inventory

KEYS = [("P", "W"), ("P", "V"), ("Q", "W")]


def random_plan(seed, events, hot=0.7):
    rng = random.Random(seed)
    return [
        (KEYS[0] if rng.random() < hot else rng.choice(KEYS), rng.randint(1, 12), rng.choice("IO"), rng.randint(1, 60), f"s{rng.randrange(10**6):06d}-{k}")
        for k in range(events)
    ]


def pallet_by_pallet(stock, events):
    """What orders take, from a queue that holds the lot of every single pallet."""
    found = Counter()
    for key in {e[0] for e in events}:
        held = deque([OPENING] * max(stock.get(key, 0), 0))
        for _, _, way, planned, name in sorted((e for e in events if e[0] == key), key=lambda e: (e[1], e[2] != "I", e[4])):
            if way == "I":
                held.extend([name] * planned)
            else:
                found.update((*key, held.popleft(), name) for _ in range(min(planned, len(held))))
    return sorted((*who, n) for who, n in found.items())


def inputs_of(spark, stock, events):
    return make_inputs(
        spark,
        [product("P"), product("Q")],
        [shipment((day(d) - AS_OF).days, w, q, i, key) for key, d, w, q, i in events],
        [ledger_row(f"t{k}", q, key=key) for k, (key, q) in enumerate(stock.items())],
    )


@pytest.mark.parametrize(("seed", "blocks", "stretch"), [(1, 1, 1 << 16), (2, 9, 50), (3, 4, 1)])
def test_orders_take_the_oldest_pallets(spark, seed, blocks, stretch):
    stock, events = {KEYS[0]: 90, KEYS[1]: -5}, random_plan(seed, 300 if stretch > 1 else 60)
    inputs, horizon = inputs_of(spark, stock, events), Horizon(AS_OF, blocks)
    projected = projected_inventory(inputs, horizon, "clamped")
    found = lot_matches(projected, current_inventory(inputs.transactions(), AS_OF), stretch)
    assert sorted(map(tuple, found.collect())) == pallet_by_pallet(stock, events)


def test_sums_per_order_are_its_filled_part(spark):
    stock, events = {KEYS[0]: 30, KEYS[2]: 700}, random_plan(4, 200)
    inputs, horizon = inputs_of(spark, stock, events), Horizon(AS_OF)
    taken = lot_matching(inputs, horizon).groupBy("shipment_id").agg(F.sum("pallets").alias("pallets"))
    filled = order_readiness(inputs, horizon, "clamped").selectExpr("shipment_id", "planned_pallet_quantity - missing_pallets AS pallets")
    assert sorted(map(tuple, taken.collect())) == sorted(map(tuple, filled.filter("pallets > 0").collect()))


def test_nothing_to_match(spark):
    for stock, events in (({}, []), ({KEYS[0]: 9}, []), ({}, [(KEYS[0], 3, "O", 5, "o")]), ({}, [(KEYS[0], 3, "I", 5, "i")])):
        assert lot_matching(inputs_of(spark, stock, events), Horizon(AS_OF)).collect() == []
