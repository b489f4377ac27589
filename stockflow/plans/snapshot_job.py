"""The whole job as one snapshot: all tables become visible together, counted while they are written.

Each input is deduplicated and judged once. Shipments and ledger go by verdict, warehouse and
month into one new folder: that of the valid rows is the published table, the few others are
written from theirs into quarantine. Row counts and broken rules are observed in that one pass,
the rules of the result while it is published. A broken rule, or more rejected rows than allowed,
stops the job before its manifest is written, so readers keep the snapshot before.

None of this depends on the as-of date. Snapshots of several dates are therefore made of the same
folders, and each has its own stock and readiness.

Spark adds up observed values over all finished tasks, so rows of tasks that ran again after a
loss may count twice. Counts are therefore held against the rows of the written tables, which
Parquet files state, and counted again from the judged table where they differ.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stockflow import contract
from stockflow.functions.columns import as_date, month_key
from stockflow.operators import publish, quality
from stockflow.operators.balance import current_inventory
from stockflow.operators.events import future_events
from stockflow.operators.policies import NETTED
from stockflow.operators.sequence import running_totals
from stockflow.plans.readiness import Horizon, Inputs, readiness_from_totals
from stockflow.plans.reports import readiness_summary
from stockflow.session import remove, scratch_removed
from stockflow.sources.snapshots import Draft, Snapshot, Store

SHIPMENT_REJECTS = "quarantine_shipments"
TRANSACTION_REJECTS = "quarantine_transactions"

Counts = dict[str, dict[str, int]]

# what holds for every row of the readiness table
READINESS_INVARIANTS = {
    "missing_exactly_when_not_filled": f"(missing_pallets > 0) = (readiness_status IN ('{contract.WAITING}', '{contract.SHORT}'))",
    "date_exactly_when_not_short": f"(earliest_available_date IS NULL) = (readiness_status = '{contract.SHORT}')",
    "filled_on_its_own_date": "missing_pallets > 0 OR earliest_available_date = scheduled_date",
    "waiting_for_a_later_date": f"readiness_status <> '{contract.WAITING}' OR earliest_available_date > scheduled_date",
    "stock_never_negative": "available_before_order >= 0 AND projected_inventory_after_order >= 0",
    "status_known": f"readiness_status IN {contract.READINESS_STATUSES}",
}


class BrokenInvariant(RuntimeError):
    """The job was stopped before its snapshot became visible."""


@dataclass(frozen=True)
class Published:
    """What a job published: its snapshot and the counts of its inputs and result."""

    store: Store
    snapshot: Snapshot
    counts: Counts

    def readiness(self) -> DataFrame:
        return read(self.store, contract.READINESS, self.snapshot)

    def summary(self) -> DataFrame:
        return readiness_summary(self.readiness())

    def quality_report(self) -> DataFrame:
        """The input counts as (dataset, metric, rows)."""
        rows = [(name, metric, n) for name, own in self.counts.items() if name != contract.READINESS for metric, n in own.items()]
        return self.store.spark.createDataFrame(rows, "dataset string, metric string, rows bigint")


# tables of a snapshot: schema, partition columns, format
LAYOUT = {
    contract.PRODUCTS: (contract.PRODUCT_SCHEMA, []),
    contract.SHIPMENTS: (contract.SHIPMENT_SCHEMA, publish.PARTITIONS),
    contract.TRANSACTIONS: (contract.TRANSACTION_SCHEMA, publish.PARTITIONS),
    contract.INVENTORY: (contract.INVENTORY_SCHEMA, []),
    contract.READINESS: (contract.READINESS_SCHEMA, publish.PARTITIONS),
}


def read(store: Store, table: str, snapshot: Snapshot | Draft | None = None, where: Callable[[dict], bool] | None = None) -> DataFrame:
    schema, partitions = LAYOUT[table]
    return store.read(table, schema, partitions, snapshot, where)


def read_rejects(store: Store, table: str, snapshot: Snapshot | Draft | None = None) -> DataFrame:
    schema = contract.SHIPMENT_SCHEMA if table == SHIPMENT_REJECTS else contract.TRANSACTION_SCHEMA
    folders = (snapshot or store.latest()).tables[table]
    return store.spark.read.schema(schema).json([f"{store.folder}/{f}" for f in folders])


def register(store: Store, snapshot: Snapshot | None = None) -> None:
    """The tables of a snapshot under the contract's names, for SQL; one snapshot for all of them."""
    chosen = snapshot or store.latest()
    for table in LAYOUT:
        if table in chosen.tables:
            read(store, table, chosen).createOrReplaceTempView(table)


def _metrics(rules: quality.Rules) -> dict[str, str]:
    return {
        "deduplicated": "count(*)",
        "valid": f"count_if({quality.is_valid(rules)})",
        "rejected": f"count_if(NOT {quality.is_valid(rules)})",
        **{f"broken_{rule}": f"count_if(NOT coalesce({check}, false))" for rule, check in rules.items()},
    }


def _values(observation: Observation) -> dict[str, int] | None:
    """What was observed; None where Spark knew that there are no rows and ran nothing over them."""
    try:
        return observation.get
    except Py4JJavaError:
        return None


def _judged(
    name: str,
    raw: DataFrame,
    once: Callable[[DataFrame], DataFrame],
    rules: quality.Rules,
    write: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, dict[str, int]]:
    """Deduplicated rows with their verdict, as `write` leaves them, and their counts."""
    seen, found = Observation(f"{name}-read"), Observation(f"{name}-judged")
    metrics = [F.expr(value).alias(metric) for metric, value in _metrics(rules).items()]
    judged = once(raw.observe(seen, F.count(F.lit(1)).alias("read"))).withColumn(contract.VERDICT, F.expr(quality.is_valid(rules)))
    table = write(judged.observe(found, *metrics))
    before, after = _values(seen), _values(found)
    counts = {**before, **after} if before and after else None
    if counts is None or counts["deduplicated"] != table.count():
        counts = {"read": raw.count(), **table.agg(*metrics).first().asDict()}
    return table, counts


def _split(draft: Draft, table: str, rejects: str, schema: str, day: str) -> Callable[[DataFrame], DataFrame]:
    """Writes judged rows as a table of valid ones and as quarantine; returns them as written."""

    def write(judged: DataFrame) -> DataFrame:
        store = draft.store
        folder = draft.replace(table, lambda path: publish.publish_judged(judged, path, day))
        valid = [f for f in store.parts(folder) if f.endswith(f"{contract.VERDICT}=true")]
        others = [f for f in store.parts(folder) if f not in valid]
        draft.tables[table] = valid
        rejected = publish.read_rejected(store.spark, [draft.path(f) for f in others], schema)
        draft.replace(rejects, lambda path: publish.quarantine(rejected, path))
        for other in others:
            remove(store.spark, draft.path(other))
        kept = read(store, table, draft).select(*contract.column_names(schema)).withColumn(contract.VERDICT, F.lit(True))
        broken = read_rejects(store, rejects, draft).withColumn(contract.VERDICT, F.lit(False))
        return kept.unionByName(broken)

    return write


def _check(counts: Counts, max_rejected: float | None) -> None:
    for name, own in counts.items():
        if own["valid"] + own["rejected"] != own["deduplicated"] or own["deduplicated"] > own["read"]:
            raise BrokenInvariant(f"{name}: rows do not add up: {own}")
        if max_rejected is not None and own["rejected"] > max_rejected * own["deduplicated"]:
            raise BrokenInvariant(f"{name}: {own['rejected']} of {own['deduplicated']} rows rejected, {max_rejected:.1%} allowed")


def _publish_readiness(draft: Draft, readiness: DataFrame, invariants: dict[str, str]) -> dict[str, int]:
    """Write the result and count its rows and what breaks the rules."""
    seen = Observation("readiness")
    broken = [F.expr(f"count_if(NOT coalesce({check}, false))").alias(f"broken_{name}") for name, check in invariants.items()]
    observed = readiness.observe(seen, F.count(F.lit(1)).alias("orders"), *broken)
    draft.replace(contract.READINESS, lambda path: publish.publish_readiness(observed, path))
    counts = _values(seen)
    if counts is None:
        counts = read(draft.store, contract.READINESS, draft).agg(F.count(F.lit(1)).alias("orders"), *broken).first().asDict()
    wrong = {name: n for name, n in counts.items() if name != "orders" and n}
    if wrong:
        raise BrokenInvariant(f"{contract.READINESS}: {wrong}")
    return counts


def _publish_inputs(draft: Draft, inputs: Inputs, max_rejected: float | None) -> Counts:
    """Write what no as-of date changes: the three tables and the quarantine."""

    def all_products(judged: DataFrame) -> DataFrame:
        # products that break a rule are counted and kept
        draft.replace(contract.PRODUCTS, lambda path: publish.publish_table(judged.drop(contract.VERDICT), path))
        return read(draft.store, contract.PRODUCTS, draft)

    shipments = _split(draft, contract.SHIPMENTS, SHIPMENT_REJECTS, contract.SHIPMENT_SCHEMA, "scheduled_date")
    ledger = _split(draft, contract.TRANSACTIONS, TRANSACTION_REJECTS, contract.TRANSACTION_SCHEMA, "transaction_date")
    counts = {}
    for name, raw, once, rules, write in (
        ("products", "products_read", Inputs.products, quality.PRODUCT_RULES, all_products),
        ("shipments", "shipments_read", Inputs.deduped_shipments, quality.SHIPMENT_RULES, shipments),
        ("transactions", "transactions_read", Inputs.deduped_transactions, quality.TRANSACTION_RULES, ledger),
    ):
        judge = lambda df, raw=raw, once=once: once(replace(inputs, **{raw: df}))
        _, counts[name] = _judged(name, getattr(inputs, raw), judge, rules, write)
    _check(counts, max_rejected)
    for name, table in (("shipments", contract.SHIPMENTS), ("transactions", contract.TRANSACTIONS)):
        if read(draft.store, table, draft).count() != counts[name]["valid"]:
            raise BrokenInvariant(f"{table}: not all of {counts[name]['valid']} valid rows were published")
    return counts


def _publish_as_of(draft: Draft, counts: Counts, horizon: Horizon, policy: str, invariants: dict[str, str]) -> Published:
    """Write stock and readiness of an as-of date beside the draft's other tables, and commit."""
    store = draft.store
    as_of, after = as_date(horizon.as_of), as_date(horizon.as_of).strftime("%Y-%m")
    with scratch_removed(store.spark):
        ledger = read(store, contract.TRANSACTIONS, draft).filter(F.col("event_month") <= month_key(F.lit(as_of)))
        draft.replace(contract.INVENTORY, lambda path: publish.publish_table(current_inventory(ledger, as_of), path))
        schedule = read(store, contract.SHIPMENTS, draft).filter(F.col("event_month") >= after).drop("event_month")
        totals = running_totals(future_events(schedule, as_of), read(store, contract.INVENTORY, draft), horizon.blocks)
        readiness = readiness_from_totals(totals, read(store, contract.PRODUCTS, draft), as_of, policy)
        counts = {**counts, contract.READINESS: _publish_readiness(draft, readiness, invariants)}
    return Published(store, draft.commit(as_of, {"policy": policy, "counts": counts}), counts)


def run_dates(
    inputs: Inputs,
    folder: str,
    horizons: Iterable[Horizon],
    policy: str = NETTED,
    max_rejected: float | None = None,
    invariants: dict[str, str] = READINESS_INVARIANTS,
) -> list[Published]:
    """Publish all tables under `folder`, as one snapshot for each as-of date.

    `max_rejected` is the share of a table's rows that may go to quarantine. The snapshots share
    the tables that no date changes; one of them follows the other, so nobody may publish between.
    """
    store = Store(inputs.shipments_read.sparkSession, folder)
    draft = store.draft()
    counts, done = _publish_inputs(draft, inputs, max_rejected), []
    for horizon in horizons:
        done.append(_publish_as_of(draft, counts, horizon, policy, invariants))
        draft = store.draft(done[-1].snapshot)
    return done


def run(
    inputs: Inputs,
    folder: str,
    horizon: Horizon,
    policy: str = NETTED,
    max_rejected: float | None = None,
    invariants: dict[str, str] = READINESS_INVARIANTS,
) -> Published:
    """Publish all tables under `folder` as one snapshot of the as-of date."""
    return run_dates(inputs, folder, [horizon], policy, max_rejected, invariants)[0]
