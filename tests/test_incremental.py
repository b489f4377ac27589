"""Batches of changed rows against full runs over all rows given so far."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from tables import AS_OF, ledger_row, make_inputs, product, shipment

from stockflow import contract, queries
from stockflow.operators.balance import current_inventory
from stockflow.plans import incremental
from stockflow.plans import readiness as plan
from stockflow.plans.readiness import Horizon, order_readiness
from stockflow.session import shared_folder
from stockflow.sources.snapshots import Store, partition_of

SCHEMAS = (contract.PRODUCT_SCHEMA, contract.SHIPMENT_SCHEMA, contract.TRANSACTION_SCHEMA)


def rows(df):
    return sorted(map(repr, map(tuple, df.select(sorted(df.columns)).collect())))


def key(rng, keys):
    n = rng.randrange(keys)
    return f"PRD-{n % 7}", f"WH-{n % 3}"


def random_batch(rng, n, keys=21, ids=60):
    """Rows with few ids, so that batches correct each other; some invalid, late or without a key."""
    odd = lambda value, chance=0.04: None if rng.random() < chance else value
    products = [product(odd(f"PRD-{rng.randrange(7)}"), rng.choice([0, 5, 30])) for _ in range(n // 10)]
    shipments = [
        shipment(odd(rng.randint(-40, 200)), rng.choice("IIOOX"), rng.choice([0, 3, 9, 40, 501]), odd(f"s{rng.randrange(ids)}"), key(rng, keys), rng.choice(["SCHEDULED", "CANCELLED"]))
        for _ in range(n)
    ]
    ledger = [ledger_row(odd(f"t{rng.randrange(ids)}"), rng.choice([-9, 4, 20, 700]), odd(rng.randint(-300, 30)), key(rng, keys)) for _ in range(n)]
    return products, shipments, ledger


def frames(spark, batch):
    return [spark.createDataFrame(part, schema) for part, schema in zip(batch, SCHEMAS)]


@pytest.mark.parametrize("seed", [1])
def test_stock_after_each_batch_is_that_of_all_rows(spark, tmp_path, seed):
    rng = random.Random(seed)
    store, given = Store(spark, str(tmp_path)), []
    for as_of in (AS_OF, AS_OF, AS_OF + timedelta(days=9), AS_OF - timedelta(days=100)):
        given += random_batch(rng, 60)[2]
        incremental.append_ledger(store, spark.createDataFrame(given[-60:], contract.TRANSACTION_SCHEMA), as_of)
        whole = make_inputs(spark, [], [], given)
        assert rows(incremental.stock(store)) == rows(current_inventory(whole.transactions(), as_of))
        kept = incremental.kept_rows(store, incremental.LEDGER, store.latest()).drop("event_month")
        assert rows(kept) == rows(whole.deduped_transactions())


def spoil(store, kind, state, months):
    """Make the files of some months unreadable."""
    for folder in store.leaves(state.tables[kind.table]):
        if partition_of(folder)["event_month"] in months:
            for file in Path(store.folder, folder).glob("*.parquet"):
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
                file.write_bytes(b"not to be read")


def test_months_without_changes_are_not_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = [ledger_row(f"t{k}", 5, -30 * k) for k in range(12)]
    incremental.append_ledger(store, spark.createDataFrame(first, contract.TRANSACTION_SCHEMA), AS_OF)
    state = store.latest()
    months = {partition_of(f)["event_month"] for f in store.leaves(state.tables[contract.TRANSACTIONS])}
    late = [ledger_row("late", 100, -30 * 5), ledger_row("t7", 4, -30 * 5), ledger_row("t2", 5, -30 * 2)]
    touched = {(AS_OF - timedelta(days=30 * k)).strftime("%Y-%m") for k in (2, 5, 7)}
    spoil(store, incremental.LEDGER, state, months - touched)
    incremental.append_ledger(store, spark.createDataFrame(late, contract.TRANSACTION_SCHEMA), AS_OF)
    # t7 has a second row now; the first by all columns is the one of the later date
    assert [r.current_inventory for r in incremental.stock(store).collect()] == [12 * 5 + 100]
    moved = {partition_of(f)["event_month"] for f in set(store.leaves(store.latest().tables[contract.TRANSACTIONS])) - set(store.leaves(state.tables[contract.TRANSACTIONS]))}
    assert moved < touched


def test_new_keys_neither_read_nor_write_kept_rows(spark, tmp_path):
    """Months whose kept rows all stay are not read: their new keys are files beside them."""
    store = Store(spark, str(tmp_path))
    first = [ledger_row(f"t{k}", 5, -30 * k) for k in range(4)]
    incremental.append_ledger(store, spark.createDataFrame(first, contract.TRANSACTION_SCHEMA), AS_OF)
    state = store.latest()
    months = {partition_of(f)["event_month"] for f in store.leaves(state.tables[contract.TRANSACTIONS])}
    spoil(store, incremental.LEDGER, state, months)
    more = [ledger_row(f"n{k}", 2, -30 * k) for k in range(4)]
    incremental.append_ledger(store, spark.createDataFrame(more, contract.TRANSACTION_SCHEMA), AS_OF)
    assert [r.current_inventory for r in incremental.stock(store).collect()] == [4 * 5 + 4 * 2]
    assert set(store.leaves(state.tables[contract.TRANSACTIONS])) < set(store.leaves(store.latest().tables[contract.TRANSACTIONS]))


@pytest.mark.parametrize("batches", [1, 2])
def test_a_batch_is_deduplicated_once(spark, tmp_path, monkeypatch, batches):
    seen, own = [], incremental.dedup
    monkeypatch.setattr(incremental, "dedup", lambda df, key: seen.append(key) or own(df, key))
    store = Store(spark, str(tmp_path))
    for k in range(batches):
        rows = [ledger_row("t", 9 - k), ledger_row("t", 5 - k), ledger_row(None, 3)]
        incremental.append_ledger(store, spark.createDataFrame(rows, contract.TRANSACTION_SCHEMA), AS_OF)
    assert seen == ["transaction_id"] * batches
    assert [r.current_inventory for r in incremental.stock(store).collect()] == [6 - batches]


def test_a_batch_that_changes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    batch = spark.createDataFrame([ledger_row("t", 5), ledger_row(None, 5)], contract.TRANSACTION_SCHEMA)
    incremental.append_ledger(store, batch, AS_OF)
    before = store.latest().tables[contract.TRANSACTIONS]
    for again in (batch, batch.limit(0)):
        incremental.append_ledger(store, again, AS_OF)
        assert store.latest().tables[contract.TRANSACTIONS] == before
        assert [r.current_inventory for r in incremental.stock(store).collect()] == [5]


def test_a_key_whose_last_row_goes_has_no_stock(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    one = lambda key, quantity: spark.createDataFrame([ledger_row("t", quantity, key=key)], contract.TRANSACTION_SCHEMA)
    incremental.append_ledger(store, one(("PRD-2", "WH-EAST"), 5), AS_OF)
    incremental.append_ledger(store, one(("PRD-1", "WH-EAST"), 9), AS_OF)
    assert [tuple(r) for r in incremental.stock(store).collect()] == [("PRD-1", "WH-EAST", 9)]


@pytest.mark.parametrize("policy", ["clamped"])
def test_readiness_after_each_batch_is_that_of_all_rows(spark, tmp_path, policy):
    rng = random.Random(5)
    store = Store(spark, str(tmp_path))
    given = [[], [], []]
    for as_of, n in ((AS_OF, 150), (AS_OF, 8), (AS_OF, 4), (AS_OF + timedelta(days=20), 5)):
        batch = random_batch(rng, n, ids=200)
        given = [a + b for a, b in zip(given, batch)]
        before = order_readiness(make_inputs(spark, *given), Horizon(as_of), policy)
        snapshot = incremental.update(store, as_of, *frames(spark, batch), policy=policy)
        assert rows(incremental.readiness(store).drop("event_month")) == rows(before)
        known = snapshot.facts["recomputed_keys"]
        assert known is None if n in (150, 5) else known < 21


def test_only_changed_keys_are_computed_again(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    keys = [(f"PRD-{k}", w) for k in range(5) for w in ("WH-EAST", "WH-WEST")]
    shipments = [shipment(10 + k, "O", 5, f"s{k}-{key}", key) for k in range(3) for key in keys]
    ledger = [ledger_row(f"t{key}", 12, key=key) for key in keys]
    products = [product(f"PRD-{k}", 1) for k in range(5)]
    incremental.update(store, AS_OF, *frames(spark, (products, shipments, ledger)))
    seen = []
    own = incremental.running_totals
    monkeypatch.setattr(incremental, "running_totals", lambda events, *more: seen.append(events.count()) or own(events, *more))

    def changed(products=(), shipments=(), ledger=()):
        snapshot = incremental.update(store, AS_OF, *frames(spark, (list(products), list(shipments), list(ledger))))
        return snapshot.facts["recomputed_keys"]

    assert changed(shipments=[shipment(11, "I", 9, "in", keys[0])]) == 1 and seen.pop() == 4
    assert changed(ledger=[ledger_row("t9", 3, key=keys[3]), ledger_row("t8", 3, 5, key=keys[4])]) == 1
    assert changed(products=[product("PRD-2", 0)]) == 2 and seen.pop() == 6
    # a past shipment, an unknown product and a change of nothing
    assert changed([product("PRD-9", 7)], [shipment(-3, "O", 4, "old", keys[7])]) == 0
    given = make_inputs(
        spark,
        [*products, product("PRD-2", 0), product("PRD-9", 7)],
        [*shipments, shipment(11, "I", 9, "in", keys[0]), shipment(-3, "O", 4, "old", keys[7])],
        [*ledger, ledger_row("t9", 3, key=keys[3]), ledger_row("t8", 3, 5, key=keys[4])],
    )
    assert rows(incremental.readiness(store).drop("event_month")) == rows(order_readiness(given, Horizon(AS_OF)))


def test_partitions_of_other_keys_are_taken_over(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    shipments = [shipment(40 * k, "O", 5, f"s{k}", ("PRD-1", f"WH-{k % 2}")) for k in range(1, 6)]
    incremental.update(store, AS_OF, *frames(spark, ([product()], shipments, [])))
    before = store.leaves(store.latest().tables[contract.READINESS])
    incremental.update(store, AS_OF, ledger=frames(spark, ([], [], [ledger_row("t", 3, key=("PRD-1", "WH-1"))]))[2])
    after = store.leaves(store.latest().tables[contract.READINESS])
    assert {partition_of(f)["warehouse_id"] for f in set(before) & set(after)} == {"WH-0"}
    assert {partition_of(f)["warehouse_id"] for f in set(after) - set(before)} == {"WH-1"}


def test_no_scratch_is_left(spark, tmp_path):
    before = set(Path(shared_folder(spark)).iterdir())
    incremental.update(Store(spark, str(tmp_path)), date(2026, 8, 1), *frames(spark, random_batch(random.Random(1), 30)))
    assert set(Path(shared_folder(spark)).iterdir()) == before


@pytest.mark.parametrize("name", ["publish_incremental", "snapshot_replace"])
def test_two_policies_judge_the_inputs_once(spark, monkeypatch, name):
    seen, own = [], plan.dedup
    monkeypatch.setattr(plan, "dedup", lambda df, key, *more: seen.append(key) or own(df, key, *more))
    east, west = ("PRD-1", "WH-EAST"), ("PRD-1", "WH-WEST")
    given = make_inputs(spark, [product()], [shipment(3, "O", 5, "a", east), shipment(9, "O", 4, "b", west)], [ledger_row("t", 3, key=east)])
    monkeypatch.setattr(queries, "inputs", lambda *_: given)
    found = queries.QUERIES[name](spark, "").collect()
    assert sorted(seen) == ["product_id", "shipment_id", "transaction_id"]
    assert sorted((r.shipment_id, r.warehouse_id) for r in found) == [("a", "WH-EAST"), ("b", "WH-WEST")]
