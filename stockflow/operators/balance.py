"""Stock on hand from the ledger."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.contract import STOCK_KEY
from stockflow.functions.columns import as_date, at_least_zero


def current_inventory(transactions: DataFrame, as_of: str | date) -> DataFrame:
    """Pallets on hand per product and warehouse at the end of `as_of`, never negative.

    Sums are combined in the map tasks, so the shuffle carries one row per key and task.
    """
    return (
        transactions.filter(F.col("transaction_date") <= F.lit(as_date(as_of)))
        .groupBy(*STOCK_KEY)
        .agg(F.sum("pallet_quantity").alias("on_hand"))
        .select(*STOCK_KEY, at_least_zero(F.col("on_hand")).alias("current_inventory"))
    )


def inventory_trend(transactions: DataFrame, as_of: str | date) -> DataFrame:
    """Ledger balance per warehouse at the end of each day with movements.

    The running sum works on one row per warehouse and day, so its groups are bounded
    by the calendar and not by the ledger.
    """
    daily = (
        transactions.filter(F.col("transaction_date") <= F.lit(as_date(as_of)))
        .groupBy("warehouse_id", "transaction_date")
        .agg(F.sum("pallet_quantity").alias("net_pallets"))
    )
    so_far = Window.partitionBy("warehouse_id").orderBy("transaction_date")
    return daily.withColumn(
        "ledger_balance",
        F.sum("net_pallets").over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
