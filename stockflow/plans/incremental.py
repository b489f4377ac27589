"""Stock and readiness kept up to date from batches of changed rows.

The state is a snapshot store of its own. It holds each table's deduplicated rows by month,
valid or not, an index of their keys, the sums of the ledger, and the readiness table. A batch
of rows, new ones, corrections and late ones alike, gives a new snapshot that equals a full
run over all rows ever given:

* the row kept for a key is the first by a total order, so the kept row and the batch's rows are
  enough to find the next one; the index tells in which months kept rows of the batch's keys lie;
* only months in which a kept row changes are read and written again; others are taken over, and
  get their new keys as files beside their own;
* stock changes by what changed rows take away and bring, and by the days an as-of date moves;
* readiness is computed again for the (product, warehouse) keys whose shipments, stock or safety
  stock changed, and only the partitions that hold orders of such keys are written again.

A new as-of date changes every readiness row, and so does another policy; then all keys are
computed again, from the kept rows. Null keys share one row, as in the full run. What is
collected are names of months and partitions, bounded by the calendar and the warehouses.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow import contract
from stockflow.functions.columns import as_date, at_least_zero, month_key
from stockflow.operators import publish, quality
from stockflow.operators.dedup import dedup
from stockflow.operators.events import future_events
from stockflow.operators.policies import NETTED
from stockflow.operators.sequence import running_totals
from stockflow.plans.readiness import readiness_from_totals
from stockflow.session import scratch_removed, written
from stockflow.sources.snapshots import Draft, Snapshot, Store, partition_of

MONTH = "event_month"
# the month of rows without a date, and of tables without months
NO_MONTH = "none"
ON_HAND = "on_hand"
ON_HAND_SCHEMA = "product_id string, warehouse_id string, pallets bigint, entries bigint"
INDEX_SCHEMA = f"id string, {MONTH} string"


@dataclass(frozen=True)
class Kind:
    """One of the input tables, and where its kept rows and keys lie."""

    table: str
    schema: str
    key: str
    day: str | None
    rules: quality.Rules

    @property
    def columns(self) -> list[str]:
        return contract.column_names(self.schema)

    @property
    def index(self) -> str:
        return f"{self.table}_index"

    def month(self, row: str = "") -> Column:
        if self.day is None:
            return F.lit(NO_MONTH)
        return F.coalesce(month_key(F.col(f"{row}{self.day}")), F.lit(NO_MONTH))


PRODUCTS = Kind(contract.PRODUCTS, contract.PRODUCT_SCHEMA, "product_id", None, quality.PRODUCT_RULES)
SHIPMENTS = Kind(contract.SHIPMENTS, contract.SHIPMENT_SCHEMA, "shipment_id", "scheduled_date", quality.SHIPMENT_RULES)
LEDGER = Kind(contract.TRANSACTIONS, contract.TRANSACTION_SCHEMA, "transaction_id", "transaction_date", quality.TRANSACTION_RULES)


def kept_rows(store: Store, kind: Kind, state: Snapshot | Draft, months: set[str] | None = None) -> DataFrame:
    """The kept rows of a table with their month, of all months or of some."""
    if kind.table not in state.tables:
        return store.spark.createDataFrame([], f"{kind.schema}, {MONTH} string")
    where = None if months is None else (lambda p: p[MONTH] in months)
    return store.read(kind.table, kind.schema, [MONTH], state, where)


def _months(*rows: DataFrame) -> set[str]:
    together = reduce(DataFrame.unionByName, [r.select(MONTH) for r in rows])
    return {r[0] for r in together.distinct().collect()}


def _months_of(store: Store, kind: Kind, state: Draft, batch: DataFrame) -> set[str] | None:
    """Months that have all kept rows of the batch's keys; None where all rows have to be read.

    Ids are compared by their hashes, which are narrow: equal ones can only add a month.
    """
    if not kind.day or kind.index not in state.tables:
        return None
    index = store.read(kind.index, INDEX_SCHEMA, (), state).select(F.xxhash64("id").alias("_hash"), MONTH)
    return _months(index.join(batch.select(F.xxhash64(kind.key).alias("_hash")), "_hash", "left_semi"))


def _first_load(store: Store, draft: Draft, kind: Kind, batch: DataFrame) -> DataFrame:
    """`merge` without any kept rows: all that changed is the table itself."""
    rows = dedup(batch, kind.key).withColumn(MONTH, kind.month()).hint("rebalance", F.col(MONTH))
    draft.replace_where(kind.table, lambda path: rows.write.partitionBy(MONTH).parquet(path))
    kept = kept_rows(store, kind, draft)
    if kind.day:
        index = kept.select(F.col(kind.key).alias("id"), MONTH)
        draft.append(kind.index, lambda path: index.write.parquet(path))
    changed = kept.select(F.col(kind.key).alias("_id"), F.struct(*kind.columns).alias("after"))
    return changed.withColumn("before", F.lit(None).cast(changed.schema["after"].dataType))


def _rank(row: str, kind: Kind) -> Column:
    """What orders the rows of a key as `dedup` does: all other columns, nulls last."""
    others = [f"{row}.{c}" for c in kind.columns if c != kind.key]
    return F.struct(*[x for k, c in enumerate(others) for x in (F.col(c).isNull().alias(f"n{k}"), F.col(c).alias(f"c{k}"))])


def merge(store: Store, draft: Draft, kind: Kind, batch: DataFrame) -> DataFrame:
    """Take a batch of rows into the kept rows of its table.

    Returns what changed: one row per key with `before` and `after`. `before` is null for a new
    key. Months in which a kept row goes are written again; others get their new rows beside
    the old ones.
    """
    batch = batch.select(*kind.columns)
    if kind.table not in draft.tables:
        return _first_load(store, draft, kind, batch)
    packed = F.struct(*kind.columns)
    kept = kept_rows(store, kind, draft, _months_of(store, kind, draft, batch))
    old = kept.select(F.col(kind.key).alias("_old"), packed.alias("before"))
    new = dedup(batch, kind.key).select(F.col(kind.key).alias("_id"), packed.alias("after"))
    compared = new.join(old, F.col("_id").eqNullSafe(F.col("_old")), "left").drop("_old")
    wins = F.col("before").isNull() | (_rank("after", kind) < _rank("before", kind))
    changed = written(compared.filter(wins), f"changed-{kind.table}")

    gone = changed.filter("before IS NOT NULL").select(kind.month("before.").alias(MONTH), "_id")
    gone = written(gone, f"gone-{kind.table}")
    come = changed.select("after.*").withColumn(MONTH, kind.month())
    worn, months = _months(gone), _months(come)
    if not months:
        return changed
    # kept rows are written where they are read: only new ones are gathered by month
    rows = come.hint("rebalance", F.col(MONTH))
    if worn:
        stays = kept_rows(store, kind, draft, worn)
        same = F.col(kind.key).eqNullSafe(F.col("_id")) & (stays[MONTH] == gone[MONTH])
        rows = stays.join(gone, same, "left_anti").unionByName(rows)
    before = store.leaves(draft.tables[kind.table])
    folder = draft.replace(kind.table, lambda path: rows.write.partitionBy(MONTH).parquet(path))
    draft.tables[kind.table] = [*(f for f in before if partition_of(f).get(MONTH) not in worn), *store.leaves([folder])]
    if kind.day:
        moved = ~kind.month("before.").eqNullSafe(kind.month("after.")) | F.col("before").isNull()
        index = changed.filter(moved).select(F.col("_id").alias("id"), kind.month("after.").alias(MONTH))
        draft.append(kind.index, lambda path: index.write.parquet(path))
    return changed


def _moves(rows: DataFrame, sign: int) -> DataFrame:
    return quality.valid_rows(rows, quality.TRANSACTION_RULES).select(
        *contract.STOCK_KEY, (F.col("pallet_quantity") * sign).cast("bigint").alias("pallets"), F.lit(sign).cast("bigint").alias("entries")
    )


def _stock_changes(store: Store, draft: Draft, changed: DataFrame | None, was: date | None, as_of: date) -> DataFrame:
    """(product, warehouse, pallets, entries) that come or go on the way to `as_of`."""
    parts = []
    day = F.col("transaction_date")
    if changed is not None and was is not None:
        parts += [
            _moves(changed.filter(f"{side} IS NOT NULL").select(f"{side}.*").filter(day <= F.lit(was)), sign)
            for side, sign in (("before", -1), ("after", 1))
        ]
    if was is None:
        parts.append(_moves(kept_rows(store, LEDGER, draft).filter(day <= F.lit(as_of)), 1))
    elif was != as_of:
        low, high, sign = (was, as_of, 1) if was < as_of else (as_of, was, -1)
        first, last = low.strftime("%Y-%m"), high.strftime("%Y-%m")
        between = kept_rows(store, LEDGER, draft).filter(F.col(MONTH).between(first, last))
        parts.append(_moves(between.filter((day > F.lit(low)) & (day <= F.lit(high))), sign))
    if not parts:
        return store.spark.createDataFrame([], ON_HAND_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _on_hand(store: Store, state: Snapshot | Draft) -> DataFrame:
    if ON_HAND not in state.tables:
        return store.spark.createDataFrame([], ON_HAND_SCHEMA)
    return store.read(ON_HAND, ON_HAND_SCHEMA, (), state)


def _summed(moves: DataFrame) -> DataFrame:
    return moves.groupBy(*contract.STOCK_KEY).agg(F.sum("pallets").alias("pallets"), F.sum("entries").alias("entries"))


def stock(store: Store, state: Snapshot | Draft | None = None) -> DataFrame:
    """Pallets on hand, as `current_inventory` gives them, from the kept sums."""
    held = _on_hand(store, state or store.latest()).filter("entries > 0")
    return held.select(*contract.STOCK_KEY, at_least_zero(F.col("pallets")).alias("current_inventory"))


def _take_ledger(store: Store, draft: Draft, was: date | None, as_of: date, ledger: DataFrame | None) -> DataFrame:
    """Ledger rows into the state, and stock to `as_of`; returns the keys whose stock changed."""
    changed = merge(store, draft, LEDGER, ledger) if ledger is not None else None
    moves = _summed(_stock_changes(store, draft, changed, was, as_of)).filter("pallets <> 0 OR entries <> 0")
    moves = written(moves, "stock-changes")
    held = _summed(_on_hand(store, draft).unionByName(moves)).filter("entries <> 0")
    draft.replace(ON_HAND, lambda path: held.write.parquet(path))
    return moves.filter("pallets <> 0").select(*contract.STOCK_KEY)


def _as_of(state: Snapshot) -> date | None:
    return None if state.as_of is None else as_date(state.as_of)


def append_ledger(store: Store, ledger: DataFrame, as_of: str | date) -> Snapshot:
    """The next snapshot of the stock: rows of the ledger added, and the as-of date moved to `as_of`."""
    state, as_of = store.current(), as_date(as_of)
    if contract.READINESS in state.tables:
        raise ValueError("this store keeps readiness, too: use update")
    draft = store.draft(state)
    with scratch_removed(store.spark):
        _take_ledger(store, draft, _as_of(state), as_of, ledger)
    return draft.commit(as_of)


def _event_keys(changed: DataFrame, as_of: date) -> DataFrame:
    """Keys with a future event that came, went or changed."""
    sides = [changed.filter(f"{side} IS NOT NULL").select(f"{side}.*") for side in ("before", "after")]
    rows = future_events(quality.valid_rows(sides[0].unionByName(sides[1]), quality.SHIPMENT_RULES), as_of)
    return rows.select(*contract.STOCK_KEY)


def _restocked(changed: DataFrame) -> DataFrame:
    """Products whose safety stock changed."""
    old, new = (F.coalesce(f"{side}.safety_stock_pallets", F.lit(0)) for side in ("before", "after"))
    return changed.filter((old != new) & F.col("_id").isNotNull()).select(F.col("_id").alias("product_id"))


def readiness(store: Store, state: Snapshot | Draft | None = None) -> DataFrame:
    return store.read(contract.READINESS, contract.READINESS_SCHEMA, publish.PARTITIONS, state)


def _recomputed(store: Store, draft: Draft, as_of: date, policy: str, keys: DataFrame | None, blocks: int | None) -> DataFrame:
    """Readiness of the orders of some keys, or of all."""
    month = as_of.strftime("%Y-%m")
    kept = kept_rows(store, SHIPMENTS, draft).filter((F.col(MONTH) >= month) & (F.col(MONTH) <= "9999"))
    events = future_events(quality.valid_rows(kept.drop(MONTH), quality.SHIPMENT_RULES), as_of)
    if keys is not None:
        events = events.join(keys, contract.STOCK_KEY, "left_semi")
    products = kept_rows(store, PRODUCTS, draft).drop(MONTH)
    return readiness_from_totals(running_totals(events, stock(store, draft), blocks), products, as_of, policy)


def update(
    store: Store,
    as_of: str | date,
    products: DataFrame | None = None,
    shipments: DataFrame | None = None,
    ledger: DataFrame | None = None,
    policy: str = NETTED,
    blocks: int | None = None,
) -> Snapshot:
    """The next snapshot of stock and readiness, from any of the three tables' changed rows.

    The snapshot's facts state how many keys were computed again (null: all).
    """
    state, as_of = store.current(), as_date(as_of)
    draft = store.draft(state)
    with scratch_removed(store.spark):
        stocked = _take_ledger(store, draft, _as_of(state), as_of, ledger)
        planned = merge(store, draft, SHIPMENTS, shipments) if shipments is not None else None
        described = merge(store, draft, PRODUCTS, products) if products is not None else None
        if contract.READINESS not in state.tables or _as_of(state) != as_of or state.facts.get("policy") != policy:
            table = _recomputed(store, draft, as_of, policy, None, blocks)
            draft.replace(contract.READINESS, lambda path: publish.publish_readiness(table, path))
            return draft.commit(as_of, {"policy": policy, "recomputed_keys": None})

        before = readiness(store, state)
        parts = [stocked]
        if planned is not None:
            parts.append(_event_keys(planned, as_of))
        if described is not None:
            parts.append(before.join(_restocked(described), "product_id", "left_semi").select(*contract.STOCK_KEY))
        keys = written(reduce(DataFrame.unionByName, parts).distinct(), "changed-keys")
        number = keys.count()
        if number:
            after = written(_recomputed(store, draft, as_of, policy, keys, blocks), "changed-orders")
            after = after.withColumn(MONTH, month_key("scheduled_date"))
            gone = before.join(keys, contract.STOCK_KEY, "left_semi")
            places = gone.select(*publish.PARTITIONS).unionByName(after.select(*publish.PARTITIONS)).distinct()
            touched = {tuple(r) for r in places.collect()}
            inside = lambda p: tuple(p[c] for c in publish.PARTITIONS) in touched
            same = store.read(contract.READINESS, contract.READINESS_SCHEMA, publish.PARTITIONS, state, inside)
            rows = same.join(keys, contract.STOCK_KEY, "left_anti").unionByName(after).drop(MONTH)
            draft.replace_where(contract.READINESS, lambda path: publish.publish_readiness(rows, path), inside)
    return draft.commit(as_of, {"policy": policy, "recomputed_keys": number})
