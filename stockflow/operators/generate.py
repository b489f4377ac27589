"""Distributed generation of the three input tables from row ids.

Every value is an expression of the row's id (and of the joined product), so any task
can be computed again on its own and nothing is shuffled except the product lookups.
Ids come from `spark.range` or from any table with a bigint `id` column.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow import contract
from stockflow.functions.columns import as_date, draw, pick, text_number
from stockflow.session import written

# Fixed values of the generated tables.
CATEGORIES = ["Beverage", "Food", "Household", "Paper", "Personal Care"]
PACKAGING = ["Cases", "Drums", "Bags", "Cartons"]
UNITS_FIRST, UNITS_STEP, UNITS_KINDS = 36, 12, 5
AREAS = 12
SAFETY_FIRST, SAFETY_SPAN = 8, 28
PLANNED_FIRST, PLANNED_SPAN = 4, 52
CANCELLED_EVERY = 97
DELAYED_EVERY = 31
# of each ledger type: the sign of its quantity (None: by parity) and how many sizes it has
LEDGER_TYPES = {
    "RECEIPT": (1, 55),
    "SHIPMENT": (-1, 48),
    "TRANSFER_IN": (1, 55),
    "TRANSFER_OUT": (-1, 18),
    "PUTAWAY": (0, 1),
    "ADJUSTMENT": (None, 8),
}
TRANSFERRED_SPAN, ADJUSTED_SPAN = 18, 8
LINKED_OF_FOUR = 2
LOCATIONS = 40
FIRST_DAY = date(2026, 4, 1)
SCHEDULE_DAYS = 211
LEDGER_DAYS = 123
LAST_COMPLETED_DAY = 122
INBOUND_PERCENT = 47
DEFAULT_TRANSACTIONS = 100_000_000
DEFAULT_SHIPMENTS = 10_000_000
DEFAULT_PRODUCTS = 10_000
DEFAULT_PARTITIONS = 400
DEFAULT_SEED = 1

# Fixed values of the drawn ledger: noise on completed quantities, posting lag in days,
# and the shares of operational events in percent.
ACTUAL_NOISE = [-3, -2, -1, 0, 0, 0, 1, 2]
POSTING_LAG = [0, 0, 0, 1]
OPENING_FIRST, OPENING_LAST = 35, 180
OPERATION_SHARES = [("PUTAWAY", 45), ("TRANSFER_IN", 18), ("TRANSFER_OUT", 18), ("ADJUSTMENT", 19)]
HISTORY_DAYS = 120


def _id() -> Column:
    return F.col("id")


def _integer(value: Column) -> Column:
    return value.cast("int")


def _numbered(prefix: str, width: int, number: Column) -> Column:
    return F.format_string(f"{prefix}%0{width}d", number)


def _cycle(values, number: Column | None = None) -> Column:
    number = _id() if number is None else number
    return pick(list(values), _integer(number % len(values)))


def _day(start: date, offset: Column) -> Column:
    return F.date_add(F.lit(start), _integer(offset))


# --- tables by formula ---------------------------------------------------------


def products(ids: DataFrame) -> DataFrame:
    return ids.select(
        _numbered("PRD-", 5, _id() + 1).alias("product_id"),
        _cycle(CATEGORIES).alias("product_category"),
        _cycle(PACKAGING).alias("packaging_type"),
        _integer(_id() % UNITS_KINDS * UNITS_STEP + UNITS_FIRST).alias("standard_units_per_pallet"),
        F.concat(F.lit("AREA-"), (_id() % AREAS + 1).cast("string")).alias("storage_area"),
        _integer(_id() % SAFETY_SPAN + SAFETY_FIRST).alias("safety_stock_pallets"),
    )


def shipments(ids: DataFrame, product_count: int = DEFAULT_PRODUCTS) -> DataFrame:
    """The schedule. A `product_count` coprime to 100 gives every product both directions."""
    day = _id() % SCHEDULE_DAYS
    planned = _integer(_id() % PLANNED_SPAN + PLANNED_FIRST)
    done = day <= LAST_COMPLETED_DAY
    status = (
        F.when(_id() % CANCELLED_EVERY == 0, contract.CANCELLED)
        .when(_id() % DELAYED_EVERY == 0, contract.DELAYED)
        .when(done, "COMPLETED")
        .otherwise("SCHEDULED")
    )
    return ids.select(
        _numbered("SHP-", 10, _id() + 1).alias("shipment_id"),
        _numbered("PRD-", 5, _id() % product_count + 1).alias("product_id"),
        _cycle(contract.WAREHOUSES).alias("warehouse_id"),
        _day(FIRST_DAY, day).alias("scheduled_date"),
        planned.alias("planned_pallet_quantity"),
        F.when(done, planned).alias("actual_pallet_quantity"),
        F.when(_id() % 100 < INBOUND_PERCENT, contract.INBOUND)
        .otherwise(contract.OUTBOUND)
        .alias("shipment_type"),
        status.alias("shipment_status"),
    )


def transactions(
    ids: DataFrame,
    product_count: int = DEFAULT_PRODUCTS,
    shipment_count: int = DEFAULT_SHIPMENTS,
    balanced_adjustments: bool = False,
) -> DataFrame:
    """The ledger, its types in a fixed cycle.

    An adjustment is positive when its id is even. In the type cycle all adjustments
    have odd ids, so by default they are all negative; `balanced_adjustments` looks at
    the id's half instead and gives both signs.
    """
    parity = F.floor(_id() / 2) if balanced_adjustments else _id()
    sign = F.when(parity % 2 == 0, 1).otherwise(-1)
    kind = _id() % len(LEDGER_TYPES)
    signs = F.array(*[sign if s is None else F.lit(s) for s, _ in LEDGER_TYPES.values()])
    spans = F.array(*[F.lit(span) for _, span in LEDGER_TYPES.values()])
    chosen = _integer(kind + 1)
    amount = F.element_at(signs, chosen) * (_id() % F.element_at(spans, chosen) + 1)
    place = _id() % LOCATIONS
    return ids.select(
        _numbered("TX-", 12, _id() + 1).alias("transaction_id"),
        F.when(_id() % 4 < LINKED_OF_FOUR, _numbered("SHP-", 10, _id() % shipment_count + 1)).alias("shipment_id"),
        _numbered("PRD-", 5, _id() % product_count + 1).alias("product_id"),
        _cycle(contract.WAREHOUSES).alias("warehouse_id"),
        _day(FIRST_DAY, _id() % LEDGER_DAYS).alias("transaction_date"),
        _cycle(LEDGER_TYPES).alias("transaction_type"),
        _integer(amount).alias("pallet_quantity"),
        F.concat(F.lit("LOC-"), (place + 1).cast("string")).alias("source_location"),
        F.concat(F.lit("LOC-"), (place + 2).cast("string")).alias("destination_location"),
    )


# --- drawn ledger ----------------------------------------------------------------
#
# Opening balances, postings of completed shipments and operational events. Draws are a
# hash of (seed, number), so they need no order. Transaction ids are made of the ids they
# belong to, or of a number, behind different prefixes; so they are unique for any ids.


def opening_balances(product_table: DataFrame, as_of: str | date, seed: int = DEFAULT_SEED) -> DataFrame:
    """One opening row per product and warehouse: 35 to 180 pallets, 120 days before `as_of`.

    The three warehouses are exploded from a literal list: rows grow by a factor of
    three inside the task and nothing is joined.
    """
    number = text_number("product_id") * len(contract.WAREHOUSES) + F.col("warehouse_number")
    warehouses = F.array(*[F.lit(w) for w in contract.WAREHOUSES])
    return (
        product_table.select("product_id", "storage_area", F.posexplode(warehouses))
        .withColumnsRenamed({"pos": "warehouse_number", "col": "warehouse_id"})
        .select(
            F.concat_ws("-", F.lit("TX-O"), "product_id", F.col("warehouse_number").cast("string")).alias("transaction_id"),
            F.lit(None).cast("string").alias("shipment_id"),
            "product_id",
            "warehouse_id",
            F.date_sub(F.lit(as_date(as_of)), HISTORY_DAYS).alias("transaction_date"),
            F.lit("ADJUSTMENT").alias("transaction_type"),
            (draw(number, seed, 1, OPENING_LAST - OPENING_FIRST + 1) + OPENING_FIRST).alias("pallet_quantity"),
            F.lit("OPENING").alias("source_location"),
            F.col("storage_area").alias("destination_location"),
        )
    )


def movements_from_shipments(
    shipment_table: DataFrame, product_table: DataFrame, seed: int = DEFAULT_SEED
) -> DataFrame:
    """The posting of each completed shipment, on the same or the next day.

    It posts the shipment's own actual quantity, and planned plus noise where there is none.
    """
    number = text_number("shipment_id")
    noise = pick(ACTUAL_NOISE, draw(number, seed, 2, len(ACTUAL_NOISE)))
    drawn = F.greatest(F.col("planned_pallet_quantity") + noise, F.lit(0))
    actual = F.coalesce("actual_pallet_quantity", drawn)
    lag = pick(POSTING_LAG, draw(number, seed, 3, len(POSTING_LAG)))
    inbound = F.col("shipment_type") == contract.INBOUND
    return (
        shipment_table.filter(F.col("shipment_status") == "COMPLETED")
        .join(product_table.select("product_id", "storage_area"), "product_id", "left")
        .select(
            F.concat(F.lit("TX-M-"), "shipment_id").alias("transaction_id"),
            "shipment_id",
            "product_id",
            "warehouse_id",
            F.date_add("scheduled_date", lag).alias("transaction_date"),
            F.when(inbound, "RECEIPT").otherwise("SHIPMENT").alias("transaction_type"),
            F.when(inbound, actual).otherwise(-actual).alias("pallet_quantity"),
            F.when(inbound, "DOCK").otherwise(F.col("storage_area")).alias("source_location"),
            F.when(inbound, F.col("storage_area")).otherwise("CUSTOMER").alias("destination_location"),
        )
    )


def operational_events(
    ids: DataFrame,
    ranked: DataFrame,
    product_count: int,
    as_of: str | date,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Put-aways, transfers and adjustments between the start of the history and `as_of`.

    Products are drawn by their rank among `product_count`, see `ranked_products`.
    """
    share = draw(_id(), seed, 5, sum(weight for _, weight in OPERATION_SHARES))
    kind, reached = F, 0
    for name, weight in OPERATION_SHARES:
        reached += weight
        kind = kind.when(share < reached, name)
    moved = draw(_id(), seed, 6, TRANSFERRED_SPAN) + 1
    adjusted = (draw(_id(), seed, 7, ADJUSTED_SPAN) + 1) * (draw(_id(), seed, 8, 2) * 2 - 1)
    event_type = F.col("transaction_type")
    quantity = (
        F.when(event_type == "PUTAWAY", 0)
        .when(event_type == "TRANSFER_OUT", -moved)
        .when(event_type == "ADJUSTMENT", adjusted)
        .otherwise(moved)
    )
    first_day = F.date_sub(F.lit(as_date(as_of)), HISTORY_DAYS)
    drawn = ids.select("id", draw(_id(), seed, 4, max(product_count, 1)).cast("bigint").alias("rank"), kind.alias("transaction_type"))
    return drawn.join(ranked, "rank").select(
        _numbered("TX-E", 12, _id()).alias("transaction_id"),
        F.lit(None).cast("string").alias("shipment_id"),
        "product_id",
        _cycle(contract.WAREHOUSES, draw(_id(), seed, 9, len(contract.WAREHOUSES))).alias("warehouse_id"),
        F.date_add(first_day, draw(_id(), seed, 10, HISTORY_DAYS + 1)).alias("transaction_date"),
        "transaction_type",
        quantity.alias("pallet_quantity"),
        F.lit("STAGING").alias("source_location"),
        F.col("storage_area").alias("destination_location"),
    )


def ranked_products(product_table: DataFrame) -> DataFrame:
    """rank (0, 1, ... by id), product_id and storage_area of the products with an id.

    Ranks are places within a range of ids plus the counts of the ranges before it, so no
    task sees more than a range. The ranges are fixed in a written table.
    """
    known = product_table.filter(F.col("product_id").isNotNull()).select("product_id", "storage_area")
    ranged = written(known.repartitionByRange("product_id").withColumn("part", F.spark_partition_id()), "ranked-products")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("product_id")) - 1
    return ranged.withColumn("place", place).join(starts, "part").select(
        (F.col("start") + F.col("place")).alias("rank"), "product_id", "storage_area"
    )


def drawn_ledger(
    product_table: DataFrame,
    shipment_table: DataFrame,
    transaction_count: int,
    as_of: str | date,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Opening balances and postings, topped up with operational events to `transaction_count` rows.

    Products and postings are written once; their sizes come from the written tables.
    """
    ranked = ranked_products(product_table)
    products_there = ranked.count()
    check_ledger_size(transaction_count, products_there)
    postings = written(movements_from_shipments(shipment_table, product_table, seed), "postings")
    missing = max(0, transaction_count - products_there * len(contract.WAREHOUSES) - postings.count())
    ids = product_table.sparkSession.range(missing)
    return (
        opening_balances(ranked, as_of, seed)
        .unionByName(postings)
        .unionByName(operational_events(ids, ranked, products_there, as_of, seed))
    )


def check_ledger_size(transaction_count: int, product_count: int) -> None:
    """The ledger must have room for one opening row per product and warehouse."""
    needed = product_count * len(contract.WAREHOUSES)
    if transaction_count < needed:
        raise ValueError(f"{transaction_count} transactions cannot hold {needed} opening balances")


# --- whole data sets -----------------------------------------------------------


def generate_tables(
    spark: SparkSession,
    product_count: int = DEFAULT_PRODUCTS,
    shipment_count: int = DEFAULT_SHIPMENTS,
    transaction_count: int = DEFAULT_TRANSACTIONS,
    partitions: int = DEFAULT_PARTITIONS,
) -> dict[str, DataFrame]:
    """The three tables by formula, keyed by their contract names."""

    def ids(count: int, parts: int) -> DataFrame:
        return spark.range(count, numPartitions=parts)

    return {
        contract.PRODUCTS: products(ids(product_count, max(8, partitions // 20))),
        contract.SHIPMENTS: shipments(ids(shipment_count, partitions), product_count),
        contract.TRANSACTIONS: transactions(ids(transaction_count, partitions), product_count, shipment_count),
    }
