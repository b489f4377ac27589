"""Whole rows through operators that add columns of their own, whatever the rows' columns are called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW = "_row"


def packed(documents: DataFrame) -> DataFrame:
    """All columns but the text as one, and the text beside it, so that it moves once."""
    own = [F.col(c).alias(f"c{k}") for k, c in enumerate(documents.columns) if c != "text"]
    return documents.select(F.struct(F.lit(True).alias("row"), *own).alias(ROW), "text")


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The packed columns under their names, and the text in its place."""
    return rows.select(*[F.col("text") if c == "text" else F.col(ROW)[f"c{k}"].alias(c) for k, c in enumerate(columns)])
