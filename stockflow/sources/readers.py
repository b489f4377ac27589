"""Readers for the three input tables and the published tables.

One reader serves CSV files and Parquet directories, so generated tables and
exported files can feed the same plans.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from stockflow import contract


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Scan `path` under a declared schema: no inference job.

    Unreadable CSV cells become null in that cell and are left to validation. For
    Parquet the declared types also cover partition columns, and the select drops
    partition columns that a writer added.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    if fmt == "parquet":
        return reader.parquet(path).select(*contract.column_names(schema))
    raise ValueError(f"unknown format {fmt!r}: use 'csv' or 'parquet'")


def _location(folder: str, table: str, fmt: str) -> str:
    suffix = ".csv" if fmt == "csv" else ""
    return f"{folder.rstrip('/')}/{table}{suffix}"


def read_products(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, _location(folder, contract.PRODUCTS, fmt), contract.PRODUCT_SCHEMA, fmt)


def read_shipments(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, _location(folder, contract.SHIPMENTS, fmt), contract.SHIPMENT_SCHEMA, fmt)


def read_transactions(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, _location(folder, contract.TRANSACTIONS, fmt), contract.TRANSACTION_SCHEMA, fmt)


# the published tables, and whether their files lie by warehouse and month
PUBLISHED = {
    contract.PRODUCTS: (contract.PRODUCT_SCHEMA, False),
    contract.SHIPMENTS: (contract.SHIPMENT_SCHEMA, True),
    contract.TRANSACTIONS: (contract.TRANSACTION_SCHEMA, True),
    contract.INVENTORY: (contract.INVENTORY_SCHEMA, False),
    contract.READINESS: (contract.READINESS_SCHEMA, True),
}


def published_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A published table under its declared schema, so that one without rows reads too."""
    schema, by_month = PUBLISHED[table]
    names = [*contract.column_names(schema), *(["event_month"] if by_month else [])]
    declared = f"{schema}, event_month string" if by_month else schema
    return spark.read.schema(declared).parquet(f"{folder.rstrip('/')}/{table}").select(*names)


def register_published(spark: SparkSession, folder: str, tables: Iterable[str] = PUBLISHED) -> None:
    """Expose published tables to SQL under the contract's table names."""
    for table in tables:
        published_table(spark, folder, table).createOrReplaceTempView(table)
