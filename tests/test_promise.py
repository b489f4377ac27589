"""Stock that is free for new orders, against a plain loop and against its meaning."""

import pytest
from tables import AS_OF
from test_lots import KEYS, inputs_of, random_plan

from stockflow.plans.readiness import Horizon, promises


def by_plain_loop(stock, events):
    found = []
    for key in {e[0] for e in events}:
        own = sorted((e for e in events if e[0] == key), key=lambda e: (e[1], e[2] != "I", e[4]))
        totals, level = [], max(stock.get(key, 0), 0)
        for _, _, way, planned, _ in own:
            level += planned if way == "I" else -planned
            totals.append(level)
        found += [(*key, e[4], totals[k], max(0, min(totals[k:]))) for k, e in enumerate(own)]
    return sorted(found)


@pytest.mark.parametrize(("seed", "blocks"), [(1, 1), (2, 4), (3, 64)])
def test_free_stock_is_the_lowest_total_from_there_on(spark, seed, blocks):
    stock, events = {KEYS[0]: 400, KEYS[1]: -5, KEYS[2]: 90}, random_plan(seed, 300)
    found = promises(inputs_of(spark, stock, events), Horizon(AS_OF, blocks)).drop("scheduled_date").collect()
    want = by_plain_loop(stock, events)
    assert sorted(map(tuple, found)) == want
    assert any(row[-1] > 0 for row in want) and any(row[-1] == 0 for row in want)


def test_an_order_of_the_free_stock_breaks_no_later_one(spark):
    key, stock = KEYS[0], {KEYS[0]: 50}
    events = [(key, 2, "O", 20, "a"), (key, 4, "O", 25, "b"), (key, 6, "I", 40, "c"), (key, 8, "O", 10, "d")]
    free = {r.shipment_id: r.available_to_promise for r in promises(inputs_of(spark, stock, events), Horizon(AS_OF)).collect()}
    assert free == {"a": 5, "b": 5, "c": 35, "d": 35}
    for taken, broken in ((5, False), (6, True)):
        more = by_plain_loop(stock, [*events, (key, 3, "O", taken, "new")])
        assert any(total < 0 for *_, total, _ in more) == broken


def test_no_events(spark):
    assert promises(inputs_of(spark, {KEYS[0]: 9}, []), Horizon(AS_OF)).collect() == []
