"""The whole job, published tables, SQL over them, and incremental publishing."""

import datetime
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tables import AS_OF as TABLES_AS_OF
from tables import ledger_row, make_inputs, product, shipment

from stockflow import contract
from stockflow import queries as named
from stockflow.operators import publish
from stockflow.plans import job, reports
from stockflow.plans.readiness import Horizon, order_readiness
from stockflow.session import shared_folder
from stockflow.sources import driver_tables, readers

AS_OF = named.AS_OF

# own questions over published tables, each with the same question asked of DataFrames
QUESTIONS = {
    "late_orders_by_status": (
        """SELECT r.readiness_status, s.shipment_status, count(*) AS orders
           FROM order_readiness r JOIN shipment_schedule s USING (shipment_id)
           GROUP BY r.readiness_status, s.shipment_status""",
        lambda t: t(contract.READINESS)
        .select("shipment_id", "readiness_status")
        .join(t(contract.SHIPMENTS).select("shipment_id", "shipment_status"), "shipment_id")
        .groupBy("readiness_status", "shipment_status")
        .agg(F.count("*").alias("orders")),
    ),
    "moved_by_month": (
        """SELECT event_month, transaction_type, sum(abs(pallet_quantity)) AS moved
           FROM inventory_transactions GROUP BY event_month, transaction_type""",
        lambda t: t(contract.TRANSACTIONS)
        .groupBy("event_month", "transaction_type")
        .agg(F.sum(F.abs("pallet_quantity")).alias("moved")),
    ),
    "stocked_products_by_category": (
        """SELECT product_category, count(DISTINCT product_id) AS products
           FROM current_inventory JOIN product_reference USING (product_id)
           WHERE current_inventory > 0 GROUP BY product_category""",
        lambda t: t(contract.INVENTORY)
        .filter("current_inventory > 0")
        .join(t(contract.PRODUCTS).select("product_id", "product_category"), "product_id")
        .groupBy("product_category")
        .agg(F.count_distinct("product_id").alias("products")),
    ),
}


def rows(df):
    return sorted(map(repr, map(tuple, df.select(sorted(df.columns)).collect())))


@pytest.fixture(scope="module", params=["csv", "parquet"])
def published(request, spark, sf_dir, tmp_path_factory):
    """Input files of one format, and the folder the job published from them."""
    base = tmp_path_factory.mktemp(request.param)
    source, target = f"{base}/in", f"{base}/out"
    for table, make in (
        (contract.PRODUCTS, driver_tables.products),
        (contract.SHIPMENTS, driver_tables.shipments),
        (contract.TRANSACTIONS, driver_tables.transactions),
    ):
        if request.param == "csv":
            publish.export_csv(make(spark, sf_dir), f"{source}/{table}.csv")
        else:
            publish.publish_table(make(spark, sf_dir), f"{source}/{table}")
    inputs = job.read_inputs(spark, source, request.param)
    summary = job.run(inputs, target, Horizon(AS_OF))
    return target, rows(summary)


def test_job_equals_the_single_plan(spark, sf_dir, published):
    folder, summary = published
    direct = named.readiness(spark, sf_dir)
    table = publish.read_back(spark, f"{folder}/{contract.READINESS}", contract.READINESS_SCHEMA)
    assert rows(table.drop("event_month")) == rows(direct)
    assert summary == rows(reports.readiness_summary(direct))


def test_job_publishes_stock_and_quarantine(spark, sf_dir, published):
    folder, _ = published
    data = named.inputs(spark, sf_dir)
    stock = named.QUERIES["current_inventory"](spark, sf_dir)
    assert rows(spark.read.parquet(f"{folder}/{contract.INVENTORY}")) == rows(stock)
    for name, schema, rejected in (
        ("shipments", contract.SHIPMENT_SCHEMA, data.rejected_shipments()),
        ("transactions", contract.TRANSACTION_SCHEMA, data.rejected_transactions()),
    ):
        assert rows(spark.read.schema(schema).json(f"{folder}/quarantine/{name}")) == rows(rejected)


def test_published_layout(published):
    folder, _ = published
    parts = {p.name for p in Path(folder, contract.READINESS).glob("warehouse_id=*/event_month=*")}
    assert parts and all(len(p) == len("event_month=1999-07") for p in parts)
    files = list(Path(folder, contract.READINESS).rglob("*.parquet"))
    assert files and all(".snappy." in f.name for f in files)
    line = next(Path(folder, "quarantine/shipments").glob("*.json")).read_text().splitlines()[0]
    assert set(json.loads(line)) == set(contract.column_names(contract.SHIPMENT_SCHEMA))


@pytest.mark.parametrize("name", sorted(QUESTIONS))
def test_sql_over_published_tables(spark, published, name):
    sql, same = QUESTIONS[name]
    folder, _ = published
    readers.register_published(spark, folder)
    found = rows(spark.sql(sql))
    assert found and found == rows(same(lambda table: readers.published_table(spark, folder, table)))


def test_published_reports_read_their_columns_only(spark, sf_dir):
    text = named.QUERIES["published_delay_rate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<(.*?)>", text).group(1) == "shipment_type:string,shipment_status:string"


def test_job_with_nothing_after_the_as_of_date(spark, sf_dir, tmp_path):
    summary = job.run(named.inputs(spark, sf_dir), str(tmp_path), Horizon("2030-01-01"))
    assert summary.collect() == []
    assert readers.published_table(spark, str(tmp_path), contract.READINESS).count() == 0


@pytest.mark.parametrize("shipments", [[], [shipment(3, "O", 5, "s")], [shipment(3, "O", 0, "bad")]])
def test_job_without_rejects_or_without_valid_rows(spark, tmp_path, shipments):
    inputs = make_inputs(spark, [product()], shipments, [ledger_row("t", 9)])
    valid = sum(s[4] > 0 for s in shipments)
    assert job.run(inputs, str(tmp_path), Horizon(TABLES_AS_OF)).count() == valid
    readers.register_published(spark, str(tmp_path))
    assert spark.sql("SELECT * FROM order_readiness").count() == valid
    rejects = spark.read.schema(contract.SHIPMENT_SCHEMA).json(f"{tmp_path}/quarantine/shipments")
    assert rejects.count() == len(shipments) - valid


def test_job_leaves_no_scratch(spark, sf_dir, tmp_path):
    shared = Path(shared_folder(spark))
    before = set(shared.iterdir())
    job.run(named.inputs(spark, sf_dir), str(tmp_path), Horizon(AS_OF))
    assert set(shared.iterdir()) == before


def test_job_in_blocks_and_other_policy(spark, sf_dir, tmp_path):
    horizon = Horizon(AS_OF, 30)
    inputs = named.inputs(spark, sf_dir)
    job.run(inputs, str(tmp_path), horizon, "clamped")
    table = spark.read.schema(contract.READINESS_SCHEMA).parquet(f"{tmp_path}/{contract.READINESS}")
    expected = named.readiness(spark, sf_dir, "clamped")
    assert rows(table.select(expected.columns)) == rows(expected)


def test_incremental_keeps_other_partitions_and_static_replaces_all(spark, sf_dir, tmp_path):
    path = str(tmp_path / "readiness")
    table = named.readiness(spark, sf_dir)
    publish.publish_readiness(table, path)
    whole = spark.read.parquet(path).count()
    update = table.filter("warehouse_id = 'WH-WEST'").limit(5).withColumn("missing_pallets", F.lit(999))
    update = spark.createDataFrame(update.collect(), contract.READINESS_SCHEMA)
    months = update.select("warehouse_id", F.date_format("scheduled_date", "yyyy-MM").alias("m")).distinct()
    replaced = table.join(
        months, (table.warehouse_id == months.warehouse_id) & (F.date_format("scheduled_date", "yyyy-MM") == F.col("m"))
    ).count()
    publish.publish_incremental(update, path)
    after = spark.read.parquet(path)
    assert after.count() == whole - replaced + 5
    assert after.filter("missing_pallets = 999").count() == 5
    publish.publish_readiness(update, path)
    assert spark.read.parquet(path).count() == 5


def test_later_as_of_date_moves_the_horizon(spark, sf_dir):
    inputs = named.inputs(spark, sf_dir)
    later = order_readiness(inputs, Horizon("1999-12-31"))
    first = later.agg(F.min("scheduled_date"), F.first("as_of_date")).first()
    assert first[0] > datetime.date(1999, 12, 31) and first[1] == datetime.date(1999, 12, 31)
