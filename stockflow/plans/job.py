"""The whole job: read the inputs, publish clean tables, quarantine, stock and readiness.

Each published table is written once and read back, under its declared schema, for the next
step. That cuts the lineage at a durable table, so a lost executor costs one step at most.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import contract
from stockflow.functions.columns import as_date, month_key
from stockflow.operators import publish
from stockflow.operators.balance import current_inventory
from stockflow.operators.events import future_events
from stockflow.operators.policies import NETTED
from stockflow.operators.quality import SHIPMENT_RULES, TRANSACTION_RULES, Rules, is_valid
from stockflow.operators.sequence import running_totals
from stockflow.plans.readiness import Horizon, Inputs, readiness_from_totals
from stockflow.plans.reports import readiness_summary
from stockflow.session import scratch_removed
from stockflow.sources import readers


def read_inputs(spark: SparkSession, folder: str, fmt: str = "parquet", keep_null_keys: bool = False) -> Inputs:
    return Inputs(
        readers.read_products(spark, folder, fmt),
        readers.read_shipments(spark, folder, fmt),
        readers.read_transactions(spark, folder, fmt),
        keep_null_keys,
    )


def _publish_split(
    deduped: DataFrame, rules: Rules, publish_valid: Callable[[DataFrame, str], None], path: str, quarantine: str
) -> None:
    """Publish the valid rows and quarantine the others.

    Rows and verdict are held on the executors' disks between the two writes; what is lost
    with an executor is computed again.
    """
    checked = deduped.withColumn("is_valid", F.expr(is_valid(rules))).persist(StorageLevel.DISK_ONLY)
    try:
        publish_valid(checked.filter("is_valid").drop("is_valid"), path)
        publish.quarantine(checked.filter("NOT is_valid").drop("is_valid"), quarantine)
    finally:
        checked.unpersist()


def published_schedule(spark: SparkSession, folder: str, after: str | date) -> DataFrame:
    """The published schedule after a date, months before it pruned at the scan."""
    day = F.lit(as_date(after))
    table = publish.read_back(spark, f"{folder}/{contract.SHIPMENTS}", contract.SHIPMENT_SCHEMA)
    return table.filter((F.col("event_month") >= month_key(day)) & (F.col("scheduled_date") > day)).drop(
        "event_month"
    )


def published_ledger(spark: SparkSession, folder: str, until: str | date) -> DataFrame:
    """The published ledger up to a date, months after it pruned at the scan."""
    day = F.lit(as_date(until))
    table = publish.read_back(spark, f"{folder}/{contract.TRANSACTIONS}", contract.TRANSACTION_SCHEMA)
    return table.filter((F.col("event_month") <= month_key(day)) & (F.col("transaction_date") <= day)).drop(
        "event_month"
    )


def run(inputs: Inputs, folder: str, horizon: Horizon, policy: str = NETTED) -> DataFrame:
    """Publish everything under `folder` and return the summary by readiness status."""
    spark = inputs.shipments_read.sparkSession
    folder = folder.rstrip("/")

    publish.publish_table(inputs.products(), f"{folder}/{contract.PRODUCTS}")

    _publish_split(
        inputs.deduped_shipments(),
        SHIPMENT_RULES,
        publish.publish_schedule,
        f"{folder}/{contract.SHIPMENTS}",
        f"{folder}/quarantine/shipments",
    )
    _publish_split(
        inputs.deduped_transactions(),
        TRANSACTION_RULES,
        publish.publish_ledger,
        f"{folder}/{contract.TRANSACTIONS}",
        f"{folder}/quarantine/transactions",
    )

    stock = current_inventory(published_ledger(spark, folder, horizon.as_of), horizon.as_of)
    publish.publish_table(stock, f"{folder}/{contract.INVENTORY}")

    with scratch_removed(spark):
        totals = running_totals(
            future_events(published_schedule(spark, folder, horizon.as_of), horizon.as_of),
            spark.read.schema(contract.INVENTORY_SCHEMA).parquet(f"{folder}/{contract.INVENTORY}"),
            horizon.blocks,
        )
        products = readers.read_products(spark, folder)
        publish.publish_readiness(
            readiness_from_totals(totals, products, horizon.as_of, policy), f"{folder}/{contract.READINESS}"
        )
    published = publish.read_back(spark, f"{folder}/{contract.READINESS}", contract.READINESS_SCHEMA)
    return readiness_summary(published)
