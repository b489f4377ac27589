"""Running totals along each key's ordered events.

Events of a (product, warehouse) key are ordered by date, arrivals before departures, then
shipment id. A key with many events is cut along this order into blocks, even within one day
and one direction. Windows run inside (key, block); one small row per day, direction and block
carries totals between days and blocks, and tells what the arrivals of a day offer.

Where keys are cut is read off a sample of narrow rows, those with the smallest hashes of their
ids, so the bounds are the same whenever they are computed and every event has one block. They
are a small table, at most one row per block, beside which the events move once, to their
(key, block). The layout is the same for every size of data; only the number of blocks is a
parameter, by default the session's number of shuffle partitions.
"""

from __future__ import annotations

from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.contract import STOCK_KEY
from stockflow.functions.columns import count_up_to
from stockflow.operators.arrivals import arrival_entries, with_arrivals
from stockflow.operators.events import stock_moves, with_opening_stock

EVENT_ORDER = ["scheduled_date", "event_priority", "shipment_id"]
IN_BLOCK = ["block", *STOCK_KEY]
# rows of the sample for each block
SAMPLED = 40


def block_bounds(like: DataFrame, blocks: int) -> DataFrame:
    """(key, _bounds): for keys that are cut, the first events of their later blocks, in order.

    The sample and what becomes of it are bounded by the number of blocks. `like` may hold rows
    that are no events; they only make a worse sample.
    """
    spark = like.sparkSession
    rows = stock_moves(like).select(*STOCK_KEY, *EVENT_ORDER).na.drop()
    sample = rows.orderBy(F.xxhash64("shipment_id")).limit(SAMPLED * blocks).collect() if blocks > 1 else []
    ordered = sorted({tuple(row) for row in sample})
    firsts = sorted({ordered[len(ordered) * k // blocks] for k in range(1, blocks)}) if ordered else []
    cut = [(*key, [own[2:] for own in group]) for key, group in groupby(firsts, lambda row: row[:2])]
    bound = pa.struct([("scheduled_date", pa.date32()), ("event_priority", pa.int32()), ("shipment_id", pa.string())])
    lists = [[dict(zip(EVENT_ORDER, event)) for event in own] for _, _, own in cut]
    columns = {name: pa.array([row[k] for row in cut], pa.string()) for k, name in enumerate(STOCK_KEY)}
    # from Arrow Spark knows the size of the table
    return spark.createDataFrame(pa.table({**columns, "_bounds": pa.array(lists, pa.list_(bound))}))


def in_blocks(moves: DataFrame, bounds: DataFrame) -> DataFrame:
    """The moves with the number of their block within the key.

    The bounds are broadcast: they have fewer rows than there are blocks.
    """
    here = f"struct({', '.join(EVENT_ORDER)})"
    block = F.expr(f"if(_bounds IS NULL, 0, {count_up_to('_bounds', here)})")
    return moves.join(F.broadcast(bounds), STOCK_KEY, "left").withColumn("block", block).drop("_bounds")


def _day_parts(placed: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per key, day, direction and block: its net and largest move, and the totals around it.

    The rows are combined in the map tasks, and a key has at most two a day and one a block, so
    the windows over them stay small. Totals only rise along the arrivals of a row and only fall
    along its departures, so a row's ends are its highest and lowest.
    """
    parts = placed.groupBy(*IN_BLOCK, "scheduled_date", "event_priority").agg(
        F.sum("signed_quantity").alias("_net"), F.max("signed_quantity").alias("_most")
    )
    came = F.when(F.col("event_priority") == 0, F.col("_net")).otherwise(0)
    order = Window.partitionBy(*STOCK_KEY).orderBy("scheduled_date", "event_priority", "block")
    up_to, before = (order.rowsBetween(Window.unboundedPreceding, last) for last in (Window.currentRow, -1))
    return (
        with_opening_stock(parts, inventory)
        .withColumn("_end", F.col("current_inventory") + F.sum("_net").over(up_to))
        .withColumn("_start", F.col("_end") - F.col("_net"))
        .withColumn("_low", F.min(F.when(F.col("event_priority") == 1, F.col("_end"))).over(before))
        .withColumn("_came", F.coalesce(F.sum(came).over(before), F.lit(0)))
        .withColumn("_head", ~F.lag("block").over(order).eqNullSafe(F.col("block")))
    )


def _carried(parts: DataFrame) -> DataFrame:
    """One row per (key, block): what the earlier blocks of the key leave, and the key's arrivals."""
    head = F.struct("block", "current_inventory", "_start", F.col("_low").alias("_carried_low"), "_came")
    per_key = parts.groupBy(*STOCK_KEY).agg(
        F.collect_list(F.when(F.col("_head"), head)).alias("_heads"), arrival_entries().alias("_entries")
    )
    heads = with_arrivals(per_key).withColumn("_head", F.explode("_heads"))
    return heads.select(*STOCK_KEY, "_head.*", "arrivals")


def running_totals(
    events: DataFrame, inventory: DataFrame, blocks: int | None = None, like: DataFrame | None = None
) -> DataFrame:
    """The stock moves of valid future `events` with opening stock and running totals.

    `like` are rows that are quicker to read than `events` and lie alike, for the sample.

    Columns next to those of the moves:

    * ``current_inventory``: opening stock of the key
    * ``prior_net_events``: net of the strictly earlier events, 0 for the first
    * ``running_total``: opening stock plus all events up to and including this one
    * ``lowest_before``: lowest running total among the strictly earlier events, or one that is
      no lower than the opening stock where there is none
    * ``arrived``: opening stock plus all arrivals up to and including this event
    * ``block``: the block of the event within its key
    * ``arrivals``: the key's days with arrivals, for `cover`
    """
    blocks = blocks or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = in_blocks(stock_moves(events), block_bounds(events if like is None else like, blocks))
    carried = _carried(_day_parts(placed, inventory))
    here = Window.partitionBy(*IN_BLOCK).orderBy(*EVENT_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    local = (
        placed.withColumn("_net", F.sum("signed_quantity").over(here))
        .withColumn("_low_before", F.min("_net").over(earlier))
        .withColumn("_in", F.sum(F.greatest("signed_quantity", F.lit(0))).over(here))
    )
    return (
        local.join(carried, IN_BLOCK)
        .withColumn("arrived", F.col("current_inventory") + F.col("_came") + F.col("_in"))
        .withColumn("running_total", F.col("_start") + F.col("_net"))
        .withColumn("lowest_before", F.least("_carried_low", F.col("_start") + F.col("_low_before")))
        .withColumn("prior_net_events", F.col("running_total") - F.col("current_inventory") - F.col("signed_quantity"))
        .drop("_net", "_low_before", "_start", "_carried_low", "_came", "_in")
    )
