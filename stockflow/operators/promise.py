"""What a new order may take without breaking an order that is already planned.

Stock on hand after an event is not free while later departures count on it. Free from an event
on is the lowest running total of the event and all that follow it in its key: whoever takes no
more than that leaves every later order as it was. Nothing is free where that total is below 0.

The lowest total of what follows is a minimum inside the event's block and one over the later
blocks of its key, of which there is one small row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.contract import STOCK_KEY
from stockflow.operators.sequence import EVENT_ORDER, IN_BLOCK


def available_to_promise(totals: DataFrame) -> DataFrame:
    """Each event of `running_totals` with the stock that is free from it on, `available_to_promise`."""
    onward = Window.partitionBy(*IN_BLOCK).orderBy(*EVENT_ORDER).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    later = Window.partitionBy(*STOCK_KEY).orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    least = totals.groupBy(*IN_BLOCK).agg(F.min("running_total").alias("_least"))
    after = least.select(*IN_BLOCK, F.min("_least").over(later).alias("_later"))
    return (
        totals.withColumn("_here", F.min("running_total").over(onward))
        .join(after, IN_BLOCK)
        # the last block of a key has none after it; least() passes over nulls
        .withColumn("available_to_promise", F.greatest(F.least("_here", "_later"), F.lit(0)))
        .drop("_here", "_later")
    )
