"""Generated tables: contract, formulas, repeatability, and use as pipeline input."""

import datetime

import pytest
from pyspark.sql import functions as F

from stockflow import contract
from stockflow import queries as named
from stockflow.operators import generate, publish
from stockflow.plans import job
from stockflow.plans.readiness import Horizon


def _types(schema):
    return [tuple(f.split()) for f in schema.split(",")]


@pytest.fixture(scope="module")
def tables(spark):
    return generate.generate_tables(spark, 101, 4000, 12000, partitions=16)


def test_tables_follow_the_contract(tables):
    for name, schema in (
        (contract.PRODUCTS, contract.PRODUCT_SCHEMA),
        (contract.SHIPMENTS, contract.SHIPMENT_SCHEMA),
        (contract.TRANSACTIONS, contract.TRANSACTION_SCHEMA),
    ):
        assert tables[name].dtypes == _types(schema)


def test_ids_are_unique_and_counted_from_one(tables):
    shipments = tables[contract.SHIPMENTS]
    found = shipments.agg(F.min("shipment_id"), F.max("shipment_id"), F.count_distinct("shipment_id")).first()
    assert tuple(found) == ("SHP-0000000001", "SHP-0000004000", 4000)


def test_partition_counts_are_chosen(tables):
    assert tables[contract.SHIPMENTS].rdd.getNumPartitions() == 16
    assert tables[contract.PRODUCTS].rdd.getNumPartitions() == 8


def test_generated_rows_are_valid_and_feed_the_job(spark, tables, tmp_path):
    source = f"{tmp_path}/in"
    publish.publish_table(tables[contract.PRODUCTS], f"{source}/{contract.PRODUCTS}")
    publish.publish_schedule(tables[contract.SHIPMENTS], f"{source}/{contract.SHIPMENTS}")
    publish.publish_ledger(tables[contract.TRANSACTIONS], f"{source}/{contract.TRANSACTIONS}")
    inputs = job.read_inputs(spark, source)
    assert inputs.rejected_shipments().count() == 0
    assert inputs.rejected_transactions().count() == 0
    summary = job.run(inputs, f"{tmp_path}/out", Horizon(contract.DEFAULT_AS_OF))
    expected = tables[contract.SHIPMENTS].filter(
        "shipment_type = 'OUTBOUND' AND shipment_status <> 'CANCELLED' AND scheduled_date > '2026-08-01'"
    )
    assert summary.agg(F.sum("orders")).first()[0] == expected.count()
    # with a product count coprime to 100 a product has both directions, so cover occurs
    assert summary.filter("readiness_status = 'WAITING_FOR_INBOUND'").count() == 1


def test_default_adjustments_are_negative_and_balanced_ones_are_not(spark):
    ids = spark.range(6000)
    adjusted = F.col("transaction_type") == "ADJUSTMENT"
    signs = lambda t: {r[0] for r in t.filter(adjusted).select(F.signum("pallet_quantity")).distinct().collect()}
    assert signs(generate.transactions(ids)) == {-1.0}
    assert signs(generate.transactions(ids, balanced_adjustments=True)) == {-1.0, 1.0}


def test_drawn_ledger_has_the_requested_size_and_signs(spark, sf_dir):
    data = named.inputs(spark, sf_dir)
    size = data.transactions_read.count()
    ledger = named.gen_ledger(spark, sf_dir)
    assert ledger.dtypes == _types(contract.TRANSACTION_SCHEMA)
    found = ledger.agg(
        F.count("*"),
        F.count_distinct("transaction_id"),
        F.count_if((F.col("transaction_type") == "PUTAWAY") & (F.col("pallet_quantity") != 0)),
        F.count_if((F.col("transaction_type") == "TRANSFER_OUT") & (F.col("pallet_quantity") >= 0)),
        F.count_if((F.col("transaction_type") == "TRANSFER_IN") & (F.col("pallet_quantity") <= 0)),
    ).first()
    assert tuple(found) == (size, size, 0, 0, 0)


def test_draws_repeat_and_spread(spark):
    ids = spark.range(20000)
    drawn = ids.select(
        "id", *[generate.draw(F.col("id"), 7, purpose, 100).alias(f"d{purpose}") for purpose in (4, 5)]
    )
    again = spark.range(20000).repartition(7).select(
        "id", *[generate.draw(F.col("id"), 7, purpose, 100).alias(f"d{purpose}") for purpose in (4, 5)]
    )
    assert drawn.exceptAll(again).count() == 0
    for name in ("d4", "d5"):
        counts = [r["count"] for r in drawn.groupBy(name).count().collect()]
        assert len(counts) == 100 and min(counts) > 120 and max(counts) < 290


def test_shares_of_operational_events(spark, sf_dir):
    ledger = named.gen_ledger(spark, sf_dir).filter("source_location = 'STAGING'")
    counts = {r["transaction_type"]: r["count"] for r in ledger.groupBy("transaction_type").count().collect()}
    total = sum(counts.values())
    for name, percent in generate.OPERATION_SHARES:
        assert abs(100 * counts[name] / total - percent) < 4


def test_ledger_size_check(spark):
    generate.check_ledger_size(600, 200)
    with pytest.raises(ValueError):
        generate.check_ledger_size(599, 200)


def _shipments(spark, names, actual=None):
    rows = [(n, "PRD-1", "WH-EAST", datetime.date(2026, 7, 1), 50, actual, "INBOUND", "COMPLETED") for n in names]
    return spark.createDataFrame(rows, contract.SHIPMENT_SCHEMA)


def _products(spark, names):
    return spark.createDataFrame([(n, "Food", "Bags", 36, "Secure", 5) for n in names], contract.PRODUCT_SCHEMA)


def test_postings_of_any_ids_are_unique(spark):
    names = ["SHP-1-11", "SHP-11-1", "no digits", "12345678901234567890", "x", "é"]
    found = generate.movements_from_shipments(_shipments(spark, names), _products(spark, ["PRD-1"])).collect()
    assert len({r["transaction_id"] for r in found}) == len(names)
    assert all(47 <= r["pallet_quantity"] <= 52 for r in found)


def test_postings_agree_with_the_schedule(spark, sf_dir):
    data = named.inputs(spark, sf_dir)
    posted = generate.movements_from_shipments(data.shipments(), data.products())
    pairs = posted.select("shipment_id", "pallet_quantity").join(
        data.shipments().select("shipment_id", "actual_pallet_quantity"), "shipment_id"
    )
    assert pairs.filter("actual_pallet_quantity IS NULL").count() == 0
    assert pairs.filter("abs(pallet_quantity) <> actual_pallet_quantity").count() == 0 and pairs.count() > 0


def test_ledger_over_products_with_gaps(spark):
    products = _products(spark, ["PRD-1", "PRD-3", "other", "PRD-99999999999999999999"])
    ranks = generate.ranked_products(products).collect()
    assert sorted(r["rank"] for r in ranks) == [0, 1, 2, 3]
    assert [r["product_id"] for r in sorted(ranks)] == sorted(r["product_id"] for r in ranks)
    ledger = generate.drawn_ledger(products, _shipments(spark, ["a", "b"]), 300, "2026-08-01")
    drawn = ledger.filter("source_location = 'STAGING'").select("product_id").distinct()
    assert ledger.count() == 300 and ledger.select("transaction_id").distinct().count() == 300
    assert drawn.count() == 4


@pytest.mark.parametrize("seed", [2**40, 2_000_000, 0])
def test_draws_of_large_seeds_and_ids(spark, seed):
    ids = spark.range(2**31 + 5, 2**31 + 2005).union(spark.range(2000)).union(spark.range(2**62, 2**62 + 2000))
    drawn = [r[0] for r in ids.select(generate.draw(F.col("id"), seed, 4, 1000)).collect()]
    low, high, top = drawn[2000:4000], drawn[:2000], drawn[4000:]
    assert min(drawn) >= 0 and max(drawn) < 1000
    assert low != high and low != top and len(set(high)) > 600
