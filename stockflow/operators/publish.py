"""Writers for the published tables, the quarantine and CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from stockflow import contract
from stockflow.functions.columns import month_key

PARTITIONS = ["warehouse_id", "event_month"]
# the warehouse of rejected rows, which need not be one that a folder can be named after
REJECTED_WAREHOUSE = "rejected_warehouse_id"


def _by_month(df: DataFrame, day: str) -> DataFrame:
    """Rows gathered by storage partition.

    REBALANCE lets AQE split a partition that is too large for one task and merge small
    ones, so a busy warehouse month becomes several files of a good size.
    """
    return df.withColumn("event_month", month_key(day)).hint("rebalance", *[F.col(c) for c in PARTITIONS])


def publish_by_month(df: DataFrame, path: str, day: str, overwrite: str = "static") -> None:
    """Snappy Parquet by warehouse and month.

    `overwrite="static"` replaces the whole table. `overwrite="dynamic"` replaces only
    the partitions that `df` has rows for and leaves the others as they are.
    """
    (
        _by_month(df, day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "snappy")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def publish_readiness(readiness: DataFrame, path: str) -> None:
    publish_by_month(readiness, path, "scheduled_date")


def publish_incremental(readiness: DataFrame, path: str) -> None:
    publish_by_month(readiness, path, "scheduled_date", overwrite="dynamic")


def publish_schedule(shipments: DataFrame, path: str) -> None:
    publish_by_month(shipments, path, "scheduled_date")


def publish_ledger(transactions: DataFrame, path: str) -> None:
    publish_by_month(transactions, path, "transaction_date")


def publish_judged(judged: DataFrame, path: str, day: str) -> None:
    """Rows with a verdict: the valid ones by warehouse and month in a folder of their own, the others beside it."""
    valid, warehouse = F.col(contract.VERDICT), F.col("warehouse_id")
    rows = judged.withColumns(
        {
            "event_month": F.when(valid, month_key(day)),
            REJECTED_WAREHOUSE: F.when(~valid, warehouse),
            "warehouse_id": F.when(valid, warehouse),
        }
    )
    by = [contract.VERDICT, *PARTITIONS]
    rows.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("compression", "snappy").partitionBy(*by).parquet(path)


def read_rejected(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The other rows that `publish_judged` wrote."""
    names = contract.column_names(schema)
    if not paths:
        return spark.createDataFrame([], schema)
    own = [REJECTED_WAREHOUSE if c == "warehouse_id" else c for c in names]
    declared = StructType([StructField(c, field.dataType) for c, field in zip(own, StructType.fromDDL(schema))])
    rows = spark.read.schema(declared).parquet(*paths)
    return rows.select(*[F.col(c).alias(name) for c, name in zip(own, names)])


def publish_table(df: DataFrame, path: str) -> None:
    """A table without partitions, fully replaced."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def quarantine(rejected: DataFrame, path: str) -> None:
    """Rejected rows as JSON lines. Nulls are written out, so an all-null column survives."""
    rejected.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every file; a null is an empty cell."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_back(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A published month-partitioned table with its month column, contract order."""
    names = contract.column_names(schema)
    return spark.read.schema(f"{schema}, event_month string").parquet(path).select(*names, "event_month")
