"""The search for a first later arrival day against a plain scan, on short and very long lists."""

import bisect
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stockflow.operators.arrivals import first_cover, with_arrivals

FIRST = date(1990, 1, 1)


@pytest.mark.parametrize("days", [0, 1, 63, 64, 65, 4096, 4097, 100_000])
def test_first_later_day_that_is_enough(spark, days):
    rng = random.Random(days)
    # several entries a day, as of a day that lies in several blocks; few levels are high
    offset = [k // 3 for k in range(days)]
    netted = [rng.choice([1, 5, 9, 9, 40]) if rng.random() < 0.999 else 500 + k for k in range(days)]
    entries = spark.createDataFrame([(offset, netted)], "offset array<int>, netted array<bigint>").select(
        F.expr(f"zip_with(offset, netted, (o, n) -> struct(date_add(date '{FIRST}', o) AS day, n AS netted, -n AS clamped))").alias("_entries")
    )
    asked = [(rng.randint(-2, days // 3 + 1), rng.choice([1, 6, 41, 500, 500 + days // 2, 10**9]), rng.choice([0, 1, 1, 1])) for _ in range(300)]
    orders = spark.createDataFrame([(FIRST + timedelta(o), n, m) for o, n, m in asked], "scheduled_date date, need bigint, missing_pallets bigint")
    found = orders.join(F.broadcast(with_arrivals(entries)), F.lit(True)).select(
        "scheduled_date", "need", "missing_pallets", first_cover("netted", "need").alias("day"), first_cover("clamped", "-need").alias("other")
    )

    def scan(after, need, missing, reached):
        if not missing:
            return None
        later = range(bisect.bisect_right(offset, after), days)
        return next((FIRST + timedelta(offset[k]) for k in later if reached(netted[k], need)), None)

    expected = [
        (FIRST + timedelta(o), n, m, scan(o, n, m, lambda have, need: have >= need), scan(o, n, m, lambda have, need: -have >= -need))
        for o, n, m in asked
    ]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_a_key_without_arrivals(spark):
    orders = spark.sql("SELECT date '2026-08-01' AS scheduled_date, 5L AS need, 1L AS missing_pallets")
    entry = "array<struct<day: date, netted: bigint, clamped: bigint>>"
    none = with_arrivals(orders.withColumn("_entries", F.lit(None).cast(entry)))
    assert none.select(first_cover("netted", "need")).first()[0] is None
