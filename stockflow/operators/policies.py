"""What an unfilled part of an order means for the stock that follows.

``netted``
    the unfilled part stays owed: later arrivals first fill the old gap.

``clamped``
    the unfilled part is dropped: the balance starts again at zero.

Both come from the same running totals. Let ``S`` be the running total before an event
and ``L`` the lowest running total among the earlier events. A balance that is cut off
at zero after every event then equals ``S - min(L, 0)``, so the clamped policy needs no
sequential loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.contract import OUTBOUND
from stockflow.operators.events import with_direction

NETTED = "netted"
CLAMPED = "clamped"
POLICIES = (NETTED, CLAMPED)


def _check(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}: use one of {POLICIES}")


def available_before(policy: str) -> str:
    """SQL for the stock an event finds."""
    _check(policy)
    if policy == NETTED:
        return "greatest(current_inventory + prior_net_events, 0L)"
    return "current_inventory + prior_net_events - least(coalesce(lowest_before, 0L), 0L)"


def project(totals: DataFrame, policy: str = NETTED) -> DataFrame:
    """Add stock before, missing pallets and stock after each event under `policy`."""
    gap = "greatest(planned_pallet_quantity - available_before_order, 0L)"
    return (
        with_direction(totals)
        .withColumn("available_before_order", F.expr(available_before(policy)))
        .withColumns(
            {
                "missing_pallets": F.expr(f"if(shipment_type = '{OUTBOUND}', {gap}, 0L)"),
                "projected_inventory_after_order": F.expr(
                    "greatest(available_before_order + signed_quantity, 0L)"
                ),
            }
        )
    )
