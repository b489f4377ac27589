"""Future events: which shipments move stock after the as-of date, and by how much."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.contract import CANCELLED, INBOUND, OUTBOUND, STOCK_KEY
from stockflow.functions.columns import as_date, event_priority, signed_quantity


def future_events(shipments: DataFrame, as_of: str | date) -> DataFrame:
    """Shipments dated after `as_of` that are not cancelled."""
    return shipments.filter(
        (F.col("scheduled_date") > F.lit(as_date(as_of))) & (F.col("shipment_status") != CANCELLED)
    )


def signed_events(events: DataFrame) -> DataFrame:
    """Events with their rank within a day and their signed effect on stock."""
    return events.withColumns({"event_priority": event_priority(), "signed_quantity": signed_quantity()})


def stock_moves(events: DataFrame) -> DataFrame:
    """The columns that running totals need: key, order within the key, signed quantity.

    Direction and planned quantity are left out, as the sign and size of the move hold
    both. Every later step then reads the same narrow rows, so Spark shuffles them once
    and reuses that shuffle.
    """
    return signed_events(events).select(
        *STOCK_KEY, "scheduled_date", "event_priority", "shipment_id", "signed_quantity"
    )


def with_direction(moves: DataFrame) -> DataFrame:
    """Direction and planned quantity of moves, back from the signed quantity."""
    incoming = F.col("signed_quantity") > 0
    return moves.withColumns(
        {
            "shipment_type": F.when(incoming, INBOUND).otherwise(OUTBOUND),
            "planned_pallet_quantity": F.abs("signed_quantity"),
        }
    )


def with_safety_stock(df: DataFrame, products: DataFrame) -> DataFrame:
    """Add the product's safety stock, 0 where the product is unknown.

    No broadcast hint: Spark broadcasts the two product columns when their size allows
    it and otherwise joins by shuffle, where AQE splits a product that is too large.
    """
    dimension = products.select("product_id", "safety_stock_pallets")
    return df.join(dimension, "product_id", "left").fillna(0, ["safety_stock_pallets"])


def with_opening_stock(df: DataFrame, inventory: DataFrame) -> DataFrame:
    """Add the stock on hand of the row's key, 0 where the ledger has none."""
    return df.join(inventory, STOCK_KEY, "left").fillna(0, ["current_inventory"])


def overdue_open_shipments(shipments: DataFrame, as_of: str | date) -> DataFrame:
    """Shipments still open on or before `as_of`.

    They are in neither the ledger nor the projection, so they are reported here.
    """
    return shipments.filter(
        F.col("shipment_status").isin("SCHEDULED", "DELAYED")
        & (F.col("scheduled_date") <= F.lit(as_date(as_of)))
    )
