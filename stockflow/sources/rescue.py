"""CSV tables with the text of every row that could not be read as declared.

Spark reads an unreadable cell as null, and a row with too few cells with nulls at its end. The
null is what validation judges; here the row's text and the names of the cells that failed stay
beside it, so that quarantine can show what was sent. Everything is done in the one scan: a
row's text is there only if Spark found it wanting, and only those texts are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import contract
from stockflow.operators import publish, quality
from stockflow.operators.dedup import dedup

SOURCE_TEXT = "source_text"
FAILING = "failing_columns"
MORE_CELLS = "(more cells)"
# a cell in quotes, in which commas do not end a cell
_QUOTED = r'"(?:[^"\\]|\\.)*"'


def _number_of_cells(text: Column) -> Column:
    bare = F.regexp_replace(text, _QUOTED, "")
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _failing(names: list[str]) -> Column:
    """The columns whose cell is missing, or has a text but no value, from `_cells` and `_number`."""
    bad = [
        F.when((F.col("_number") <= k) | (F.col("_cells")[name].isNotNull() & F.col(name).isNull()), F.lit(name))
        for k, name in enumerate(names)
    ]
    bad.append(F.when(F.col("_number") > len(names), F.lit(MORE_CELLS)))
    return F.when(F.col(SOURCE_TEXT).isNotNull(), F.array_compact(F.array(*bad)))


def read_rescued(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """The table under its declared schema, with `source_text` and `failing_columns` of bad rows.

    Both are null for rows that were read in full. Spark parses only the cells a query needs and
    finds a row bad or not by those; so the text is made to need all of them.
    """
    names = contract.column_names(schema)
    rows = (
        spark.read.schema(f"{schema}, {SOURCE_TEXT} string")
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", SOURCE_TEXT)
        .csv(path)
    )
    nothing_of_all = F.substring(F.concat_ws("", *names), 1, 0)
    rows = rows.withColumn(SOURCE_TEXT, F.concat(SOURCE_TEXT, nothing_of_all))
    read_again = F.from_csv(F.col(SOURCE_TEXT), ", ".join(f"`{name}` string" for name in names))
    cells = rows.withColumns({"_cells": read_again, "_number": _number_of_cells(F.col(SOURCE_TEXT))})
    return cells.withColumn(FAILING, _failing(names)).drop("_cells", "_number")


def once(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, as `dedup` keeps it: among rows with equal cells one that was read in full."""
    text = F.col(SOURCE_TEXT)
    # the text comes last in the order, a missing one first
    ordered = rows.withColumn(SOURCE_TEXT, F.coalesce(text, F.lit("")))
    kept = dedup(ordered.select(*[c for c in rows.columns if c not in (SOURCE_TEXT, FAILING)], SOURCE_TEXT, FAILING), key)
    return kept.withColumn(SOURCE_TEXT, F.nullif(text, F.lit("")))


def wanting(kept: DataFrame, rules: quality.Rules) -> DataFrame:
    """Rows that validation rejects or whose cells were not all read, with their verdict."""
    valid = F.expr(quality.is_valid(rules))
    verdict = F.when(valid, "accepted").otherwise("rejected").alias("verdict")
    return kept.filter(~valid | F.col(SOURCE_TEXT).isNotNull()).select("*", verdict)


def quarantine(kept: DataFrame, rules: quality.Rules, path: str) -> None:
    """Rejected rows and rescued texts as JSON lines."""
    publish.quarantine(wanting(kept, rules), path)
