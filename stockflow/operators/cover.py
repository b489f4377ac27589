"""First date on which a short order could be covered by a later arrival.

An arrival covers an order when its key is the same, its date is strictly later and
its level reaches what the order needs. Joining every short order with every later
arrival would grow with the square of a key's events. Instead each event carries the days
of its key's arrivals, and a short order searches them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.contract import OUTBOUND
from stockflow.operators.arrivals import first_cover
from stockflow.operators.policies import NETTED


def needed_level(policy: str) -> Column:
    """The level at which an order counts as covered.

    For `clamped` the events after the order have to bring `planned - available` on top
    of the total at the order; the order's own demand is not asked for twice.
    """
    if policy == NETTED:
        return F.col("planned_pallet_quantity").cast("bigint")
    return F.col("running_total") + F.col("missing_pallets")


def short_orders(projected: DataFrame) -> DataFrame:
    return projected.filter((F.col("shipment_type") == OUTBOUND) & (F.col("missing_pallets") > 0))


def cover_dates(projected: DataFrame, policy: str = NETTED) -> DataFrame:
    """Outbound orders with `earliest_inbound_date`; null when nothing is short or no cover comes.

    Only short orders look for a day.
    """
    orders = projected.filter(F.col("shipment_type") == OUTBOUND).withColumn("_need", needed_level(policy))
    return orders.withColumn("earliest_inbound_date", first_cover(policy, "_need")).drop("arrivals", "_need")
