"""From the three input tables to the readiness of each future order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow import contract
from stockflow.contract import STOCK_KEY
from stockflow.functions.columns import as_date
from stockflow.operators.arrivals import first_cover
from stockflow.operators.balance import current_inventory
from stockflow.operators.cover import cover_dates, needed_level
from stockflow.operators.dedup import dedup
from stockflow.operators.events import future_events, with_safety_stock
from stockflow.operators.lots import lot_matches
from stockflow.operators.policies import CLAMPED, NETTED, POLICIES, project
from stockflow.operators.promise import available_to_promise
from stockflow.operators.quality import (
    SHIPMENT_RULES,
    TRANSACTION_RULES,
    rejected_rows,
    valid_rows,
)
from stockflow.operators.sequence import running_totals
from stockflow.session import written


@dataclass(frozen=True)
class Inputs:
    """The three tables as read, and their deduplicated and validated forms."""

    products_read: DataFrame
    shipments_read: DataFrame
    transactions_read: DataFrame
    keep_null_keys: bool = False

    def products(self) -> DataFrame:
        return dedup(self.products_read, "product_id")

    def deduped_shipments(self) -> DataFrame:
        return dedup(self.shipments_read, "shipment_id", self.keep_null_keys)

    def deduped_transactions(self) -> DataFrame:
        return dedup(self.transactions_read, "transaction_id", self.keep_null_keys)

    def shipments(self) -> DataFrame:
        return valid_rows(self.deduped_shipments(), SHIPMENT_RULES)

    def transactions(self) -> DataFrame:
        return valid_rows(self.deduped_transactions(), TRANSACTION_RULES)

    def rejected_shipments(self) -> DataFrame:
        return rejected_rows(self.deduped_shipments(), SHIPMENT_RULES)

    def rejected_transactions(self) -> DataFrame:
        return rejected_rows(self.deduped_transactions(), TRANSACTION_RULES)


@dataclass(frozen=True)
class Horizon:
    """As-of date, and about the number of blocks in which the events after it are worked on.

    Without a number there are as many blocks as the session has shuffle partitions.
    """

    as_of: str | date = contract.DEFAULT_AS_OF
    blocks: int | None = None


def event_totals(inputs: Inputs, horizon: Horizon) -> DataFrame:
    """Future events with opening stock and running totals."""
    return running_totals(
        future_events(inputs.shipments(), horizon.as_of),
        current_inventory(inputs.transactions(), horizon.as_of),
        horizon.blocks,
        like=future_events(inputs.shipments_read, horizon.as_of),
    )


@dataclass(frozen=True)
class Judged:
    """What the readiness of an as-of date reads of the inputs: deduplicated, valid and summed."""

    events: DataFrame
    inventory: DataFrame
    products: DataFrame


def judged_once(inputs: Inputs, horizon: Horizon) -> Judged:
    """Scratch tables for several readiness tables of one date: the inputs are judged for the first only.

    They belong to the caller's `scratch_removed`.
    """
    return Judged(
        written(future_events(inputs.shipments(), horizon.as_of), "judged-events"),
        written(current_inventory(inputs.transactions(), horizon.as_of), "judged-inventory"),
        written(inputs.products(), "judged-products"),
    )


def readiness_of(judged: Judged, horizon: Horizon, policy: str = NETTED) -> DataFrame:
    """`order_readiness` from inputs that were judged before."""
    totals = running_totals(judged.events, judged.inventory, horizon.blocks)
    return readiness_from_totals(totals, judged.products, horizon.as_of, policy)


def projected_inventory(inputs: Inputs, horizon: Horizon, policy: str = NETTED) -> DataFrame:
    """All future events with the stock before and after them."""
    return project(event_totals(inputs, horizon), policy)


def readiness_status(missing: str, after: str, cover: str) -> Column:
    filled = F.col(missing) == 0
    return (
        F.when(filled & (F.col(after) < F.col("safety_stock_pallets")), contract.AT_RISK)
        .when(filled, contract.READY)
        .when(F.col(cover).isNotNull(), contract.WAITING)
        .otherwise(contract.SHORT)
    )


def available_date(missing: str, cover: str) -> Column:
    return F.when(F.col(missing) == 0, F.col("scheduled_date")).otherwise(F.col(cover))


def classify(orders: DataFrame, as_of: str | date) -> DataFrame:
    """Readiness rows from orders with cover dates and safety stock."""
    missing, cover = "missing_pallets", "earliest_inbound_date"
    return orders.withColumns(
        {
            "readiness_status": readiness_status(missing, "projected_inventory_after_order", cover),
            "earliest_available_date": available_date(missing, cover),
            "as_of_date": F.lit(as_date(as_of)),
        }
    ).select(*contract.column_names(contract.READINESS_SCHEMA))


def readiness_from_totals(
    totals: DataFrame, products: DataFrame, as_of: str | date, policy: str = NETTED
) -> DataFrame:
    orders = cover_dates(project(totals, policy), policy)
    return classify(with_safety_stock(orders, products), as_of)


def order_readiness(inputs: Inputs, horizon: Horizon, policy: str = NETTED) -> DataFrame:
    """One row per valid future outbound order: can it be filled, and if not, when."""
    return readiness_from_totals(event_totals(inputs, horizon), inputs.products(), horizon.as_of, policy)


def lot_matching(inputs: Inputs, horizon: Horizon) -> DataFrame:
    """What each future order takes of the opening stock and of each arrival, oldest first."""
    stock = current_inventory(inputs.transactions(), horizon.as_of)
    return lot_matches(projected_inventory(inputs, horizon, CLAMPED), stock)


def promises(inputs: Inputs, horizon: Horizon) -> DataFrame:
    """Future events with the stock that new orders may take from then on, under `netted`."""
    return available_to_promise(event_totals(inputs, horizon)).select(
        *STOCK_KEY, "scheduled_date", "shipment_id", "running_total", "available_to_promise"
    )


def policy_differences(inputs: Inputs, horizon: Horizon) -> DataFrame:
    """Orders on which the two policies disagree in status, missing pallets or date.

    Both projections lie side by side on each event, and each day of arrivals has a level for
    either policy. So both classifications come from one pass, without joining orders.
    """
    own = ["available_before_order", "missing_pallets", "projected_inventory_after_order"]
    both = event_totals(inputs, horizon)
    for policy in POLICIES:
        both = project(both, policy).withColumn(f"{policy}_need", needed_level(policy))
        both = both.withColumnsRenamed({c: f"{policy}_{c}" for c in own})
    orders = both.filter(F.col("shipment_type") == contract.OUTBOUND)
    orders = with_safety_stock(orders, inputs.products())
    compared = ["readiness_status", "missing_pallets", "earliest_available_date"]
    for policy in POLICIES:
        missing, cover = f"{policy}_missing_pallets", f"{policy}_cover"
        orders = orders.withColumn(cover, first_cover(policy, f"{policy}_need", missing)).withColumns(
            {
                f"{policy}_readiness_status": readiness_status(missing, f"{policy}_projected_inventory_after_order", cover),
                f"{policy}_earliest_available_date": available_date(missing, cover),
            }
        )
    same = [F.col(f"{NETTED}_{c}").eqNullSafe(F.col(f"{CLAMPED}_{c}")) for c in compared]
    return orders.filter(~(same[0] & same[1] & same[2])).select(
        "shipment_id", *[f"{policy}_{c}" for policy in POLICIES for c in compared]
    )
