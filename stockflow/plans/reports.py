"""Operational reports and summary figures over the readiness, schedule and ledger tables.

All of them are aggregates that Spark combines in the map tasks. Top-k reports add the
product id to their order, so that ties have one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow import contract
from stockflow.functions.columns import is_inbound, month_key, percentage


def _status(value: str) -> Column:
    return F.col("shipment_status") == value


def _planned_if(inbound: bool) -> Column:
    planned = F.when(is_inbound() if inbound else ~is_inbound(), F.col("planned_pallet_quantity"))
    return F.sum(planned.otherwise(0))


def _top(df: DataFrame, size: int, *measures: Column) -> DataFrame:
    return df.orderBy(*[m.desc() for m in measures], F.col("product_id").asc()).limit(size)


# --- readiness reports -------------------------------------------------------


def readiness_summary(readiness: DataFrame) -> DataFrame:
    return readiness.groupBy("readiness_status").agg(
        F.count("*").alias("orders"), F.sum("missing_pallets").alias("missing_pallets")
    )


def readiness_by_month(readiness: DataFrame) -> DataFrame:
    return readiness.groupBy(
        "warehouse_id", month_key("scheduled_date").alias("event_month"), "readiness_status"
    ).agg(F.count("*").alias("orders"), F.sum("missing_pallets").alias("missing_pallets"))


def attention_orders(readiness: DataFrame) -> DataFrame:
    """Orders that are not simply ready, earliest and largest gap first.

    The shipment id ends the order, so that Spark can split a day with very many orders
    over several sort tasks.
    """
    return (
        readiness.filter(F.col("readiness_status").isin(contract.AT_RISK, contract.SHORT, contract.WAITING))
        .select(
            "shipment_id",
            "product_id",
            "warehouse_id",
            "scheduled_date",
            "planned_pallet_quantity",
            "missing_pallets",
            "readiness_status",
            "earliest_available_date",
        )
        .orderBy(F.col("scheduled_date").asc(), F.col("missing_pallets").desc(), "shipment_id")
    )


def shortage_by_warehouse(readiness: DataFrame) -> DataFrame:
    constrained = F.col("readiness_status").isin(contract.SHORT, contract.WAITING)
    return (
        readiness.groupBy("warehouse_id")
        .agg(
            F.count_if(constrained).alias("constrained_orders"),
            F.sum("missing_pallets").alias("missing_pallets"),
        )
        .orderBy(F.col("missing_pallets").desc(), "warehouse_id")
    )


def top_shortages(readiness: DataFrame, size: int = 20) -> DataFrame:
    short = readiness.filter(F.col("missing_pallets") > 0)
    totals = short.groupBy("product_id").agg(
        F.count("*").alias("short_orders"), F.sum("missing_pallets").alias("missing_pallets")
    )
    return _top(totals, size, F.col("missing_pallets"))


# --- schedule and ledger reports ---------------------------------------------


def planned_volume(shipments: DataFrame) -> DataFrame:
    """Planned pallets in and out per product, cancelled shipments left out."""
    return (
        shipments.filter(~_status(contract.CANCELLED))
        .groupBy("product_id")
        .agg(
            _planned_if(inbound=True).alias("inbound_pallets"),
            _planned_if(inbound=False).alias("outbound_pallets"),
        )
    )


def top_product_volume(shipments: DataFrame, size: int = 20) -> DataFrame:
    return _top(planned_volume(shipments), size, F.col("inbound_pallets") + F.col("outbound_pallets"))


def top_adjustments(transactions: DataFrame, size: int = 20) -> DataFrame:
    totals = (
        transactions.filter(F.col("transaction_type") == "ADJUSTMENT")
        .groupBy("product_id")
        .agg(
            F.count("*").alias("adjustment_events"),
            F.sum(F.abs("pallet_quantity")).alias("adjusted_pallets"),
        )
    )
    return _top(totals, size, F.col("adjusted_pallets"))


def delay_rate(shipments: DataFrame) -> DataFrame:
    """Share of delayed shipments; cancelled ones stay in the total."""
    return (
        shipments.groupBy("warehouse_id", "shipment_type")
        .agg(
            F.count_if(_status(contract.DELAYED)).alias("delayed_shipments"),
            F.count("*").alias("total_shipments"),
        )
        .withColumn("delay_rate_pct", percentage("delayed_shipments", "total_shipments"))
    )


def top_delays(shipments: DataFrame, size: int = 20) -> DataFrame:
    totals = (
        shipments.groupBy("product_id")
        .agg(
            F.count_if(_status(contract.DELAYED)).alias("delayed_shipments"),
            F.count("*").alias("total_shipments"),
        )
        .filter(F.col("delayed_shipments") > 0)
    )
    return _top(totals, size, F.col("delayed_shipments"))


def volume_by_warehouse(shipments: DataFrame) -> DataFrame:
    return (
        shipments.filter(~_status(contract.CANCELLED))
        .groupBy("warehouse_id", "shipment_type", month_key("scheduled_date").alias("event_month"))
        .agg(
            F.count("*").alias("shipments"),
            F.sum("planned_pallet_quantity").alias("planned_pallets"),
        )
    )


def plan_vs_posted(shipments: DataFrame, transactions: DataFrame) -> DataFrame:
    """Completed shipments with planned, actual and posted pallets side by side.

    A shipment without a posting has posted nothing: 0 postings, 0 pallets.

    Postings are summed per shipment before the join, so both sides are unique on the
    join key and ledger rows without a shipment never reach it.
    """
    posted = (
        transactions.filter(F.col("shipment_id").isNotNull())
        .groupBy("shipment_id")
        .agg(F.count("*").alias("postings"), F.sum("pallet_quantity").alias("posted_pallets"))
    )
    return (
        shipments.filter(_status("COMPLETED"))
        .select("shipment_id", "shipment_type", "planned_pallet_quantity", "actual_pallet_quantity")
        .join(posted, "shipment_id", "left")
        .fillna(0, ["postings", "posted_pallets"])
    )


def partition_profile(shipments: DataFrame) -> DataFrame:
    """Rows per storage partition, and how evenly its products share them."""
    per_product = shipments.groupBy(
        "warehouse_id", month_key("scheduled_date").alias("event_month"), "product_id"
    ).count()
    return (
        per_product.groupBy("warehouse_id", "event_month")
        .agg(
            F.sum("count").alias("shipments"),
            F.count("*").alias("products"),
            F.max("count").alias("largest_product"),
        )
        .withColumn("average_product", F.col("shipments") / F.col("products"))
    )


def key_profile(events: DataFrame) -> DataFrame:
    """How evenly the events of the horizon are shared by the (product, warehouse) keys."""
    per_key = events.groupBy(*contract.STOCK_KEY).agg(F.count("*").alias("events"))
    return per_key.agg(
        F.count("*").alias("keys"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
        F.coalesce(F.max("events"), F.lit(0)).alias("largest_key"),
        F.coalesce(F.sum("events") / F.count("*"), F.lit(0.0)).alias("average_key"),
    )


# --- summary figures -----------------------------------------------------------


def status_counts(readiness: DataFrame) -> DataFrame:
    """Orders by status, one row for each of the four statuses even where it is 0."""
    counts = {
        status: F.count_if(F.col("readiness_status") == status) for status in contract.READINESS_STATUSES
    }
    return readiness.agg(*[value.alias(name) for name, value in counts.items()]).unpivot(
        [], list(counts), "readiness_status", "orders"
    )


def readiness_totals(readiness: DataFrame) -> DataFrame:
    return readiness.agg(
        F.count("*").alias("orders_evaluated"),
        F.count_if(F.col("readiness_status") != contract.READY).alias("orders_needing_attention"),
        F.coalesce(F.sum("missing_pallets"), F.lit(0)).alias("missing_pallets"),
    )


def top_movement(shipments: DataFrame, size: int = 10) -> DataFrame:
    volume = planned_volume(shipments).withColumn(
        "total_pallets", F.col("inbound_pallets") + F.col("outbound_pallets")
    )
    return _top(volume, size, F.col("total_pallets"))


def dataset_sizes(products: DataFrame, shipments: DataFrame, transactions: DataFrame) -> DataFrame:
    """Rows as read, and the number of warehouses in the schedule."""

    def line(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.alias("size")).select(F.lit(name).alias("dataset"), "size")

    return (
        line("transactions", transactions, F.count("*"))
        .unionByName(line("shipments", shipments, F.count("*")))
        .unionByName(line("products", products, F.count("*")))
        .unionByName(line("warehouses", shipments, F.count_distinct("warehouse_id")))
    )
