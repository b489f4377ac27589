"""The three input tables as views over the driver's `part` and `lineitem` tables.

The mapping is plain SQL that Spark and DuckDB both run, so it is kept as text: the
readers below and the SQL checks use the very same statements. `{part}` and
`{lineitem}` stand for the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "1999-06-30"

PRODUCTS_SQL = """
SELECT concat('PRD-', lpad(cast(p_partkey AS varchar(20)), 6, '0')) AS product_id,
       p_type AS product_category, p_brand AS packaging_type,
       cast(36 + 12 * (p_partkey % 5) AS int) AS standard_units_per_pallet,
       concat('AREA-', cast(p_partkey % 12 + 1 AS varchar(20))) AS storage_area,
       cast(p_size % 28 + 8 AS int) AS safety_stock_pallets
FROM {part}
"""

SHIPMENTS_SQL = """
WITH b AS (
  SELECT *, cast(date_trunc('week', l_shipdate) AS date) AS wk,
         cast(l_quantity AS int) AS qty
  FROM {lineitem}), c AS (
  SELECT *,
    CASE WHEN l_tax = 0.08 AND l_discount = 0.03 THEN 'RETURN'
         WHEN l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus = 'F') THEN 'INBOUND'
         ELSE 'OUTBOUND' END AS ty,
    CASE WHEN l_tax = 0.08 AND l_discount = 0.04 THEN 'UNKNOWN'
         WHEN l_discount = 0.0 THEN 'CANCELLED'
         WHEN l_discount = 0.1 THEN 'DELAYED'
         WHEN wk <= date '1999-06-30' THEN 'COMPLETED'
         ELSE 'SCHEDULED' END AS st
  FROM b)
SELECT CASE WHEN l_discount = 0.1 AND l_tax = 0.0 THEN NULL
            ELSE concat('SHP-', lpad(cast(l_orderkey AS varchar(20)), 8, '0'), '-', cast(l_linenumber AS varchar(20))) END AS shipment_id,
       CASE WHEN l_discount = 0.0 AND l_tax = 0.0 THEN NULL
            ELSE concat('PRD-', lpad(cast(l_partkey AS varchar(20)), 6, '0')) END AS product_id,
       CASE l_suppkey % 3 WHEN 0 THEN 'WH-EAST' WHEN 1 THEN 'WH-CENTRAL' ELSE 'WH-WEST' END AS warehouse_id,
       CASE WHEN l_discount = 0.09 AND l_tax = 0.0 THEN NULL ELSE wk END AS scheduled_date,
       CASE WHEN l_tax = 0.08 AND l_discount = 0.01 THEN 501
            WHEN l_tax = 0.08 AND l_discount = 0.02 THEN 0 ELSE qty END AS planned_pallet_quantity,
       CASE WHEN st = 'COMPLETED' THEN cast(greatest(qty + l_suppkey % 4 - 2, 0) AS int) END AS actual_pallet_quantity,
       ty AS shipment_type, st AS shipment_status
FROM c
"""

TRANSACTIONS_SQL = """
SELECT concat('TX-', lpad(cast(l_orderkey AS varchar(20)), 8, '0'), '-', cast(l_linenumber AS varchar(20))) AS transaction_id,
       CASE WHEN l_linenumber IN (1, 2, 7) THEN concat('SHP-', lpad(cast(l_orderkey AS varchar(20)), 8, '0'), '-', cast(l_linenumber AS varchar(20))) END AS shipment_id,
       CASE WHEN l_discount = 0.0 AND l_tax = 0.01 THEN NULL
            ELSE concat('PRD-', lpad(cast(l_partkey AS varchar(20)), 6, '0')) END AS product_id,
       CASE l_suppkey % 3 WHEN 0 THEN 'WH-EAST' WHEN 1 THEN 'WH-CENTRAL' ELSE 'WH-WEST' END AS warehouse_id,
       cast(date_trunc('week', l_shipdate) AS date) AS transaction_date,
       CASE WHEN l_tax = 0.08 AND l_discount = 0.05 THEN 'SCRAP'
            WHEN l_linenumber = 2 THEN 'SHIPMENT' WHEN l_linenumber = 3 THEN 'TRANSFER_IN'
            WHEN l_linenumber = 4 THEN 'TRANSFER_OUT' WHEN l_linenumber = 5 THEN 'PUTAWAY'
            WHEN l_linenumber = 6 THEN 'ADJUSTMENT' ELSE 'RECEIPT' END AS transaction_type,
       CASE WHEN l_tax = 0.08 AND l_discount = 0.06 THEN -501
            WHEN l_linenumber IN (2, 4) THEN -cast(l_quantity AS int)
            WHEN l_linenumber = 5 THEN 0
            WHEN l_linenumber = 6 THEN cast(l_quantity AS int) % 17 - 8
            ELSE cast(l_quantity AS int) END AS pallet_quantity,
       concat('LOC-', cast(l_suppkey % 40 + 1 AS varchar(20))) AS source_location,
       concat('LOC-', cast(l_suppkey % 40 + 2 AS varchar(20))) AS destination_location
FROM {lineitem}
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PRODUCTS_SQL, part=_table(spark, sf_dir, "part"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SHIPMENTS_SQL, lineitem=_table(spark, sf_dir, "lineitem"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TRANSACTIONS_SQL, lineitem=_table(spark, sf_dir, "lineitem"))
