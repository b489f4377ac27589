"""Which arrival fills which order: first in, first out, under the clamped policy.

Along a key's events everything that comes in stands on one line, the opening stock first and
then each arrival; what orders take stands on the same line, as each takes the oldest pallets
that are left. A lot and an order belong together where their stretches of the line overlap.
Stock is never negative, so an order only reaches lots that came before it.

Overlaps are found without pairs: the ends of lots and of orders cut the line into pieces, and
each piece belongs to the last lot and the last order begun before it. The line is worked on in
stretches of `STRETCH` pallets, so a key with very many events is spread, and an order or lot
that goes on beyond a stretch begins again in the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.contract import INBOUND, OUTBOUND, STOCK_KEY

STRETCH = 1 << 16
OPENING = "OPENING"


def _stretched(rows: DataFrame, kind: str, stretch: int) -> DataFrame:
    """(key, part, at, until, lot, taker) for each stretch that [_start, _end) touches."""
    first, last = f"_start div {stretch}", f"(_end - 1) div {stretch}"
    parts = rows.filter("_end > _start").withColumn("part", F.explode(F.expr(f"sequence({first}, {last})")))
    other = {"lot": "taker", "taker": "lot"}[kind]
    return parts.select(
        *STOCK_KEY,
        "part",
        F.greatest(F.col("_start"), F.col("part") * stretch).alias("at"),
        F.least(F.col("_end"), (F.col("part") + 1) * stretch).alias("until"),
        F.col("shipment_id").alias(kind),
        F.lit(None).cast("string").alias(other),
    )


def lot_matches(projected: DataFrame, inventory: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(product_id, warehouse_id, lot_id, shipment_id, pallets): what each order takes of each lot.

    `projected` are events under the clamped policy, `inventory` the opening stock, which is
    the lot `OPENING` of its key. Lots no order reaches and orders that get nothing have no row.
    """
    opening = inventory.select(
        *STOCK_KEY, F.lit(OPENING).alias("shipment_id"), F.lit(0).cast("bigint").alias("_start"), F.col("current_inventory").alias("_end")
    )
    ends = F.col("arrived"), F.col("arrived") - F.col("projected_inventory_after_order")
    lots = projected.filter(F.col("shipment_type") == INBOUND).select(
        *STOCK_KEY, "shipment_id", (ends[0] - F.col("planned_pallet_quantity")).alias("_start"), ends[0].alias("_end")
    )
    filled = F.col("planned_pallet_quantity") - F.col("missing_pallets")
    orders = projected.filter(F.col("shipment_type") == OUTBOUND).select(
        *STOCK_KEY, "shipment_id", (ends[1] - filled).alias("_start"), ends[1].alias("_end")
    )
    line = _stretched(lots.unionByName(opening), "lot", stretch).unionByName(_stretched(orders, "taker", stretch))
    # at one place at most one lot and one order begin; which of the two comes first does not matter
    along = Window.partitionBy("part", *STOCK_KEY).orderBy("at", F.col("lot").asc_nulls_last())
    begun = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def current(kind: str):
        return F.last(F.when(F.col(kind).isNotNull(), F.struct(F.col(kind).alias("id"), "until")), ignorenulls=True).over(begun)

    pieces = line.select(*STOCK_KEY, "at", current("lot").alias("lot"), current("taker").alias("taker"), F.lead("at").over(along).alias("next"))
    # the last piece of a stretch ends with the shorter of its lot and its order
    end = F.least("next", "lot.until", "taker.until")
    return (
        pieces.filter("lot IS NOT NULL AND taker IS NOT NULL")
        .select(*STOCK_KEY, F.col("lot.id").alias("lot_id"), F.col("taker.id").alias("shipment_id"), (end - F.col("at")).alias("pallets"))
        .filter("pallets > 0")
        .groupBy(*STOCK_KEY, "lot_id", "shipment_id")
        .agg(F.sum("pallets").alias("pallets"))
    )
