"""The physical plans are the intended ones."""

import re

import compare
import pytest

from stockflow import contract
from stockflow import queries as named
from stockflow.operators import publish
from stockflow.oracle import ORACLE_SQL
from stockflow.plans import job, reports

AS_OF = named.AS_OF


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    df.collect()
    text = plan_of(df)
    return text.split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are planned for tables of any size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(named.QUERIES))
def test_no_python_and_no_cross_product(name, spark, sf_dir):
    text = plan_of(named.QUERIES[name](spark, sf_dir))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in text


def test_copies_of_a_key_are_dropped_before_the_shuffle(spark, sf_dir):
    text = plan_of(named.inputs(spark, sf_dir).deduped_shipments())
    assert re.search(r"WindowGroupLimit.*, Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*, Partial", text)


def test_stock_is_summed_before_the_shuffle(spark, sf_dir):
    text = plan_of(named.QUERIES["current_inventory"](spark, sf_dir))
    assert re.search(r"HashAggregate.*[\s\S]*Exchange hashpartitioning\(product_id[\s\S]*partial_sum", text)


def test_readiness_reads_the_blocks_twice_at_most(spark, sf_dir, no_broadcast):
    """Events move once to their block and once as orders to their key; sums and days are small."""
    text = final_plan_of(named.readiness(spark, sf_dir))
    own = "\n".join(line for line in text.splitlines() if "ReusedExchange" not in line)
    by = [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", own)]
    assert sum("transaction_id" in k for k in by) == 1
    assert len(by) <= 11
    assert own.count("event-blocks") <= 2
    assert "ReusedExchange" in text


def test_policies_are_compared_without_joining_orders(spark, sf_dir, no_broadcast):
    text = final_plan_of(named.QUERIES["policy_diff"](spark, sf_dir))
    assert not re.search(r"Join \[shipment_id", text)


@pytest.mark.parametrize(
    ("name", "keys"),
    [
        ("attention_orders", [("scheduled_date", 1), ("missing_pallets", -1), ("shipment_id", 1)]),
        ("shortage_by_warehouse", [("missing_pallets", -1), ("warehouse_id", 1)]),
        ("order_readiness_clamped", [("scheduled_date", 1), ("warehouse_id", 1), ("shipment_id", 1)]),
        ("published_attention", [("scheduled_date", 1), ("missing_pallets", -1), ("shipment_id", 1)]),
        ("published_shortage", [("missing_pallets", -1), ("warehouse_id", 1)]),
    ],
)
def test_result_order(spark, sf_dir, name, keys):
    """Row by row, in the order of the SQL answer."""
    result = named.QUERIES[name](spark, sf_dir)
    names = sorted(result.columns)
    ordering = ", ".join(f"{c} {'DESC' if way < 0 else 'ASC'}" for c, way in keys)
    sql = f"SELECT {', '.join(names)} FROM ({ORACLE_SQL[name]}) ORDER BY {ordering}"
    assert [tuple(r) for r in result.select(names).collect()] == compare.connect(sf_dir).execute(sql).fetchall()


@pytest.mark.parametrize(
    ("name", "key"),
    [
        ("top_product_volume", "inbound_pallets + outbound_pallets"),
        ("top_adjustments", "adjusted_pallets"),
        ("kpi_top10_movement", "total_pallets"),
        ("top_delays", "delayed_shipments"),
        ("top_shortages", "missing_pallets"),
    ],
)
def test_top_reports_come_in_order(spark, sf_dir, name, key):
    result = named.QUERIES[name](spark, sf_dir)
    names = sorted(result.columns)
    sql = f"SELECT {', '.join(names)} FROM ({ORACLE_SQL[name]}) ORDER BY {key} DESC, product_id"
    assert [tuple(r) for r in result.select(names).collect()] == compare.connect(sf_dir).execute(sql).fetchall()


def test_top_reports_never_sort_everything(spark, sf_dir):
    for name in ("top_product_volume", "top_adjustments", "kpi_top10_movement", "top_delays", "top_shortages"):
        assert "TakeOrderedAndProject" in plan_of(named.QUERIES[name](spark, sf_dir))


def test_published_tables_prune_partitions_and_columns(spark, sf_dir, tmp_path):
    folder = str(tmp_path)
    data = named.inputs(spark, sf_dir)
    publish.publish_schedule(data.shipments(), f"{folder}/{contract.SHIPMENTS}")
    text = plan_of(job.published_schedule(spark, folder, AS_OF).select("shipment_id", "scheduled_date"))
    assert re.search(r"PartitionFilters: \[.*event_month.*>= 1999-06", text)
    assert "GreaterThan(scheduled_date,1999-06-30)" in text
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert schema == "shipment_id:string,scheduled_date:date"
    volume = plan_of(reports.delay_rate(spark.read.parquet(f"{folder}/{contract.SHIPMENTS}")))
    schema = re.search(r"ReadSchema: struct<(.*?)>", volume).group(1)
    assert schema == "shipment_type:string,shipment_status:string"


def test_publishing_rebalances_so_that_large_partitions_split(spark, sf_dir):
    plan = publish._by_month(named.readiness(spark, sf_dir), "scheduled_date")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(plan)
