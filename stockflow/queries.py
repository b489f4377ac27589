"""Named queries over the driver's tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import contract
from stockflow.functions.columns import text_number
from stockflow.operators import generate, publish, quality
from stockflow.operators.balance import current_inventory, inventory_trend
from stockflow.operators.cover import cover_dates, short_orders
from stockflow.operators.events import (
    future_events,
    overdue_open_shipments,
    signed_events,
    with_opening_stock,
    with_safety_stock,
)
from stockflow.operators.policies import CLAMPED, NETTED
from stockflow.plans import incremental, job, reports, snapshot_job
from stockflow.plans import readiness as plan
from stockflow.session import scratch_path, scratch_removed
from stockflow.sources import driver_tables, readers, rescue
from stockflow.sources.snapshots import Store

AS_OF = driver_tables.AS_OF
EARLIER = "1999-03-31"
MANY_BLOCKS = 64
Query = Callable[[SparkSession, str], DataFrame]


def inputs(spark: SparkSession, sf_dir: str, keep_null_keys: bool = False) -> plan.Inputs:
    return plan.Inputs(
        driver_tables.products(spark, sf_dir),
        driver_tables.shipments(spark, sf_dir),
        driver_tables.transactions(spark, sf_dir),
        keep_null_keys,
    )


def horizon(blocks: int | None = None) -> plan.Horizon:
    return plan.Horizon(AS_OF, blocks)


def readiness(spark: SparkSession, sf_dir: str, policy: str = NETTED, blocks: int | None = None) -> DataFrame:
    return plan.order_readiness(inputs(spark, sf_dir), horizon(blocks), policy)


# --- scans ---------------------------------------------------------------------


def _scan_csv(table: Callable[[SparkSession, str], DataFrame], schema: str) -> Query:
    """The table written as CSV and scanned under its declared schema."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "scan")
        publish.export_csv(table(spark, sf_dir), path)
        return readers.read_table(spark, path, schema, "csv")

    return query


# --- deduplication and validation ------------------------------------------------


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = inputs(spark, sf_dir)

    def line(name: str, deduped: DataFrame, rules: quality.Rules) -> DataFrame:
        valid = quality.is_valid(rules)
        return deduped.agg(
            F.count("*").alias("deduplicated"),
            F.expr(f"count_if({valid})").alias("valid"),
            F.expr(f"count_if(NOT {valid})").alias("rejected"),
        ).select(F.lit(name).alias("dataset"), "deduplicated", "valid", "rejected")

    return line("shipments", data.deduped_shipments(), quality.SHIPMENT_RULES).unionByName(
        line("transactions", data.deduped_transactions(), quality.TRANSACTION_RULES)
    )


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = inputs(spark, sf_dir)
    return (
        quality.quality_report("products", data.products_read, data.products(), quality.PRODUCT_RULES)
        .unionByName(
            quality.quality_report(
                "shipments", data.shipments_read, data.deduped_shipments(), quality.SHIPMENT_RULES
            )
        )
        .unionByName(
            quality.quality_report(
                "transactions",
                data.transactions_read,
                data.deduped_transactions(),
                quality.TRANSACTION_RULES,
            )
        )
    )


# --- stock and events --------------------------------------------------------------


def events_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = inputs(spark, sf_dir)
    events = signed_events(future_events(data.shipments(), AS_OF))
    stocked = with_opening_stock(events, current_inventory(data.transactions(), AS_OF))
    return with_safety_stock(stocked, data.products()).select(
        "shipment_id",
        "product_id",
        "warehouse_id",
        "scheduled_date",
        "event_priority",
        "signed_quantity",
        "current_inventory",
        "safety_stock_pallets",
    )


def running_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = plan.event_totals(inputs(spark, sf_dir), horizon())
    return totals.select("shipment_id", "signed_quantity", "prior_net_events")


def _projection(policy: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan.projected_inventory(inputs(spark, sf_dir), horizon(), policy).select(
            "shipment_id",
            "product_id",
            "warehouse_id",
            "scheduled_date",
            "shipment_type",
            "planned_pallet_quantity",
            "current_inventory",
            "available_before_order",
            "missing_pallets",
            "projected_inventory_after_order",
        )

    return query


def query_short_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected = plan.projected_inventory(inputs(spark, sf_dir), horizon())
    return short_orders(projected).select("shipment_id", "planned_pallet_quantity", "missing_pallets")


def _availability(policy: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        projected = plan.projected_inventory(inputs(spark, sf_dir), horizon(), policy)
        return short_orders(cover_dates(projected, policy)).select("shipment_id", "earliest_inbound_date")

    return query


# --- sinks, read back ---------------------------------------------------------------


def publish_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "readiness")
    publish.publish_readiness(readiness(spark, sf_dir), path)
    return publish.read_back(spark, path, contract.READINESS_SCHEMA)


def publish_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish one policy, then replace the partitions of one warehouse by the other's."""
    path = scratch_path(spark, "incremental")
    with scratch_removed(spark):
        judged = plan.judged_once(inputs(spark, sf_dir), horizon())
        publish.publish_readiness(plan.readiness_of(judged, horizon()), path)
        update = plan.readiness_of(judged, horizon(), CLAMPED).filter(F.col("warehouse_id") == "WH-EAST")
        publish.publish_incremental(update, path)
    return publish.read_back(spark, path, contract.READINESS_SCHEMA)


def publish_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "balance")
    publish.publish_table(current_inventory(inputs(spark, sf_dir).transactions(), AS_OF), path)
    return spark.read.schema(contract.INVENTORY_SCHEMA).parquet(path)


def quarantine_shipments_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "quarantine-shipments")
    publish.quarantine(inputs(spark, sf_dir).rejected_shipments(), path)
    return spark.read.schema(contract.SHIPMENT_SCHEMA).json(path)


def quarantine_transactions_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "quarantine-transactions")
    publish.quarantine(inputs(spark, sf_dir).rejected_transactions(), path)
    return spark.read.schema(contract.TRANSACTION_SCHEMA).json(path)


def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    publish.export_csv(readiness(spark, sf_dir, CLAMPED), path)
    return readers.read_table(spark, path, contract.READINESS_SCHEMA, "csv")


def _damaged_lines(shipments: DataFrame) -> DataFrame:
    """Shipments as CSV lines, a part of them with bad cells, too few or too many."""
    names = contract.column_names(contract.SHIPMENT_SCHEMA)
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names}
    pick = text_number("line") % 24
    lines = shipments.select(F.concat_ws(",", *cells.values()).alias("line"), *[v.alias(c) for c, v in cells.items()])
    bad = {
        "scheduled_date": {0: "2026-13-45", 7: "1999-8-4"},
        "planned_pallet_quantity": {1: "abc", 2: "4.0", 6: " 4"},
        "actual_pallet_quantity": {5: "n/a"},
    }
    for name, values in bad.items():
        for k, value in values.items():
            lines = lines.withColumn(name, F.when(pick == k, value).otherwise(F.col(name)))
    short = F.concat_ws(",", *names[:6])
    return lines.select(
        F.when(pick == 3, short).when(pick == 4, F.concat_ws(",", *names, F.lit("more"))).otherwise(F.concat_ws(",", *names)).alias("line")
    )


def quarantine_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What quarantine says of a CSV table with unreadable cells and rows of the wrong length."""
    source, target = scratch_path(spark, "damaged"), scratch_path(spark, "rescued")
    _damaged_lines(driver_tables.shipments(spark, sf_dir)).write.text(source)
    kept = rescue.once(rescue.read_rescued(spark, source, contract.SHIPMENT_SCHEMA, header=False), "shipment_id")
    rescue.quarantine(kept, quality.SHIPMENT_RULES, target)
    found = spark.read.schema(
        f"{contract.SHIPMENT_SCHEMA}, source_text string, failing_columns array<string>, verdict string"
    ).json(target)
    return found.withColumn("failing_columns", F.array_join("failing_columns", ","))


# --- the job, and reports as SQL over published tables -----------------------------------


def job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job into a fresh folder; its answer is the summary of what it published."""
    return job.run(inputs(spark, sf_dir), scratch_path(spark, "job"), horizon())


def _publish(spark: SparkSession, sf_dir: str, table: str, path: str) -> None:
    if table == contract.READINESS:
        publish.publish_readiness(readiness(spark, sf_dir), path)
    elif table == contract.SHIPMENTS:
        publish.publish_schedule(inputs(spark, sf_dir).shipments(), path)
    else:
        publish.publish_ledger(inputs(spark, sf_dir).transactions(), path)


def _over_published(table: str, report: Callable[[DataFrame], DataFrame]) -> Query:
    """Publish the one table that the report reads, and ask the table of that name."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark, "published")
        _publish(spark, sf_dir, table, f"{folder}/{table}")
        readers.register_published(spark, folder, [table])
        return report(spark.table(table))

    return query


PUBLISHED_REPORTS = {
    "published_attention": _over_published(contract.READINESS, reports.attention_orders),
    "published_shortage": _over_published(contract.READINESS, reports.shortage_by_warehouse),
    "published_volume": _over_published(contract.SHIPMENTS, reports.top_product_volume),
    "published_adjustments": _over_published(contract.TRANSACTIONS, reports.top_adjustments),
    "published_delay_rate": _over_published(contract.SHIPMENTS, reports.delay_rate),
}


# --- snapshots ----------------------------------------------------------------------------


def _two_snapshots(spark: SparkSession, sf_dir: str) -> Store:
    """The job as of an earlier date and as of the usual one, into one folder."""
    folder = scratch_path(spark, "snapshots")
    snapshot_job.run_dates(inputs(spark, sf_dir), folder, [plan.Horizon(as_of) for as_of in (EARLIER, AS_OF)])
    return Store(spark, folder)


def publish_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later of two snapshots: nothing of the earlier date is left in it."""
    return snapshot_job.read(_two_snapshots(spark, sf_dir), contract.READINESS)


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier of two snapshots, still readable by its date."""
    store = _two_snapshots(spark, sf_dir)
    return snapshot_job.read(store, contract.READINESS, store.latest(EARLIER))


def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One warehouse replaced by the other policy's rows, the others taken over as they are."""
    store = Store(spark, scratch_path(spark, "snapshots"))
    with scratch_removed(spark):
        judged = plan.judged_once(inputs(spark, sf_dir), horizon())
        draft = store.draft()
        draft.replace(contract.READINESS, lambda path: publish.publish_readiness(plan.readiness_of(judged, horizon()), path))
        draft = store.draft(draft.commit(AS_OF))
        update = plan.readiness_of(judged, horizon(), CLAMPED).filter(F.col("warehouse_id") == "WH-EAST")
        draft.replace_where(
            contract.READINESS, lambda path: publish.publish_readiness(update, path), lambda p: p["warehouse_id"] == "WH-EAST"
        )
    draft.commit(AS_OF)
    return snapshot_job.read(store, contract.READINESS)


def published_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts the snapshot job took while it wrote."""
    return snapshot_job.run(inputs(spark, sf_dir), scratch_path(spark, "snapshots"), horizon()).quality_report()


# --- kept up to date -----------------------------------------------------------------------


def _deal(df: DataFrame, key: str, share: int, late: int) -> tuple[DataFrame, DataFrame]:
    """The rows in two batches, `late` of `share` in the second: by key, and copies of a key apart."""
    draw = F.pmod(F.xxhash64(key, F.col(df.columns[-1]), F.col(df.columns[-2])), F.lit(share))
    return df.filter(draw >= late), df.filter(draw < late)


def incremental_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock after three batches of the ledger, late and repeated rows among them, and two as-of dates."""
    store = Store(spark, scratch_path(spark, "state"))
    first, more = _deal(driver_tables.transactions(spark, sf_dir), "transaction_id", 10, 4)
    second, third = _deal(more, "transaction_id", 20, 3)
    for batch, as_of in ((first, EARLIER), (second, AS_OF), (third, AS_OF)):
        incremental.append_ledger(store, batch, as_of)
    return incremental.stock(store)


def incremental_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readiness of a first load, brought up to date for the keys that later rows change."""
    store = Store(spark, scratch_path(spark, "state"))
    data = inputs(spark, sf_dir)
    products = _deal(data.products_read, "product_id", 50, 1)
    shipments = _deal(data.shipments_read, "product_id", 40, 1)
    ledger = _deal(data.transactions_read, "product_id", 40, 1)
    for k in range(2):
        incremental.update(store, AS_OF, products[k], shipments[k], ledger[k])
    return incremental.readiness(store)


# --- generation, driven by the ids of the given tables --------------------------------


def _part_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"))


def _line_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number for each order line; repeated lines count once."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct()
    return lines.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))


def gen_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.products(_part_ids(spark, sf_dir))


def gen_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.shipments(_line_ids(spark, sf_dir))


def gen_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.transactions(_line_ids(spark, sf_dir))


def gen_products_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "generated-products")
    publish.publish_table(gen_products(spark, sf_dir), path)
    return readers.read_table(spark, path, contract.PRODUCT_SCHEMA)


def gen_shipments_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "generated-shipments")
    publish.publish_schedule(gen_shipments(spark, sf_dir), path)
    return publish.read_back(spark, path, contract.SHIPMENT_SCHEMA)


def gen_transactions_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "generated-transactions")
    publish.publish_ledger(gen_transactions(spark, sf_dir), path)
    return publish.read_back(spark, path, contract.TRANSACTION_SCHEMA)


def opening_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.opening_balances(inputs(spark, sf_dir).products(), AS_OF)


def movements_from_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = inputs(spark, sf_dir)
    return generate.movements_from_shipments(data.shipments(), data.products())


def gen_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = inputs(spark, sf_dir)
    return generate.drawn_ledger(data.products(), data.shipments(), data.transactions_read.count(), AS_OF)


# --- registry --------------------------------------------------------------------------


def _over_readiness(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(readiness(spark, sf_dir))


def _over_shipments(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(inputs(spark, sf_dir).shipments())


def _over_transactions(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(inputs(spark, sf_dir).transactions())


QUERIES: dict[str, Query] = {
    "order_readiness": readiness,
    "order_readiness_by_block": lambda s, d: readiness(s, d, blocks=MANY_BLOCKS),
    "order_readiness_clamped": lambda s, d: readiness(s, d, CLAMPED).orderBy(
        "scheduled_date", "warehouse_id", "shipment_id"
    ),
    "policy_diff": lambda s, d: plan.policy_differences(inputs(s, d), horizon()),
    "lot_matching": lambda s, d: plan.lot_matching(inputs(s, d), horizon()),
    "available_to_promise": lambda s, d: plan.promises(inputs(s, d), horizon()),
    # scans
    "scan_products": _scan_csv(driver_tables.products, contract.PRODUCT_SCHEMA),
    "scan_shipments": _scan_csv(driver_tables.shipments, contract.SHIPMENT_SCHEMA),
    "scan_transactions": _scan_csv(driver_tables.transactions, contract.TRANSACTION_SCHEMA),
    # deduplication
    "dedup_products": lambda s, d: inputs(s, d).products(),
    "dedup_shipments": lambda s, d: inputs(s, d).deduped_shipments(),
    "dedup_transactions": lambda s, d: inputs(s, d).deduped_transactions(),
    "dedup_null_keys": lambda s, d: inputs(s, d, keep_null_keys=True).deduped_shipments(),
    # validation
    "valid_shipments": lambda s, d: inputs(s, d).shipments(),
    "valid_transactions": lambda s, d: inputs(s, d).transactions(),
    "rejected_shipments": lambda s, d: inputs(s, d).rejected_shipments(),
    "rejected_transactions": lambda s, d: inputs(s, d).rejected_transactions(),
    "split_counts": split_counts,
    "quality_report": quality_report,
    # stock and events
    "current_inventory": _over_transactions(lambda t: current_inventory(t, AS_OF)),
    "future_events": _over_shipments(lambda t: future_events(t, AS_OF)),
    "signed_events": _over_shipments(
        lambda t: signed_events(future_events(t, AS_OF)).select(
            "shipment_id", "shipment_type", "planned_pallet_quantity", "event_priority", "signed_quantity"
        )
    ),
    "events_enriched": events_enriched,
    "running_net": running_net,
    "projected_inventory": _projection(NETTED),
    "clamped_ledger": _projection(CLAMPED),
    "short_orders": query_short_orders,
    "availability_netted": _availability(NETTED),
    "availability_clamped": _availability(CLAMPED),
    # reports
    "readiness_summary": _over_readiness(reports.readiness_summary),
    "readiness_by_month": _over_readiness(reports.readiness_by_month),
    "attention_orders": _over_readiness(reports.attention_orders),
    "shortage_by_warehouse": _over_readiness(reports.shortage_by_warehouse),
    "top_product_volume": _over_shipments(reports.top_product_volume),
    "top_adjustments": _over_transactions(reports.top_adjustments),
    "delay_rate": _over_shipments(reports.delay_rate),
    # summary figures
    "kpi_status_counts": _over_readiness(reports.status_counts),
    "kpi_totals": _over_readiness(reports.readiness_totals),
    "kpi_status_counts_clamped": lambda s, d: reports.status_counts(readiness(s, d, CLAMPED)),
    "kpi_totals_clamped": lambda s, d: reports.readiness_totals(readiness(s, d, CLAMPED)),
    "kpi_top10_movement": _over_shipments(reports.top_movement),
    "kpi_dataset_sizes": lambda s, d: reports.dataset_sizes(
        driver_tables.products(s, d), driver_tables.shipments(s, d), driver_tables.transactions(s, d)
    ),
    # further questions
    "inventory_trend": _over_transactions(lambda t: inventory_trend(t, AS_OF)),
    "top_shortages": _over_readiness(reports.top_shortages),
    "top_delays": _over_shipments(reports.top_delays),
    "key_profile": lambda s, d: reports.key_profile(future_events(inputs(s, d).shipments(), AS_OF)),
    "partition_profile": _over_shipments(reports.partition_profile),
    "plan_vs_posted": lambda s, d: reports.plan_vs_posted(
        inputs(s, d).shipments(), inputs(s, d).transactions()
    ),
    "overdue_open_shipments": _over_shipments(lambda t: overdue_open_shipments(t, AS_OF)),
    "volume_by_warehouse": _over_shipments(reports.volume_by_warehouse),
    # sinks
    "publish_readiness": publish_readiness,
    "publish_incremental": publish_incremental,
    "publish_balance": publish_balance,
    "quarantine_shipments_sink": quarantine_shipments_sink,
    "quarantine_transactions_sink": quarantine_transactions_sink,
    "quarantine_rescued": quarantine_rescued,
    "export_csv": export_csv,
    # the job and reports over published tables
    "job_summary": job_summary,
    **PUBLISHED_REPORTS,
    # snapshots
    "publish_snapshot": publish_snapshot,
    "snapshot_as_of": snapshot_as_of,
    "snapshot_replace": snapshot_replace,
    "published_quality": published_quality,
    # kept up to date
    "incremental_inventory": incremental_inventory,
    "incremental_readiness": incremental_readiness,
    # generation
    "gen_products": gen_products,
    "gen_shipments": gen_shipments,
    "gen_transactions": gen_transactions,
    "gen_products_sink": gen_products_sink,
    "gen_shipments_sink": gen_shipments_sink,
    "gen_transactions_sink": gen_transactions_sink,
    "opening_balances": opening_balances,
    "movements_from_shipments": movements_from_shipments,
    "gen_ledger": gen_ledger,
}
