"""Row validation from declared rules, the two-way split, and the quality report.

A rule is a SQL condition with a name. Conditions are kept as text, so that they can be
listed, logged and counted one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow import contract

Rules = dict[str, str]


def _present(*names: str) -> Rules:
    return {f"{name}_present": f"{name} IS NOT NULL" for name in names}


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


SHIPMENT_RULES: Rules = {
    **_present("shipment_id", "product_id", "warehouse_id", "scheduled_date"),
    "planned_in_range": f"planned_pallet_quantity BETWEEN {contract.MIN_PLANNED} AND {contract.MAX_PALLETS}",
    "type_known": _one_of("shipment_type", contract.SHIPMENT_TYPES),
    "status_known": _one_of("shipment_status", contract.SHIPMENT_STATUSES),
}

TRANSACTION_RULES: Rules = {
    **_present("transaction_id", "product_id", "warehouse_id", "transaction_date"),
    # a limit on the absolute quantity; BETWEEN cannot overflow where abs can
    "quantity_in_range": f"pallet_quantity BETWEEN -{contract.MAX_PALLETS} AND {contract.MAX_PALLETS}",
    "type_known": _one_of("transaction_type", contract.TRANSACTION_TYPES),
}

# Checks for the product table. They are reported; the readiness plans reject no product.
PRODUCT_RULES: Rules = {
    **_present("product_id"),
    "safety_stock_not_negative": "safety_stock_pallets >= 0",
}


def _all(rules: Rules) -> str:
    return " AND ".join(f"({rule})" for rule in rules.values())


def _holds(condition: str) -> str:
    """A condition that is unknown because of a null counts as broken."""
    return f"coalesce({condition}, false)"


def is_valid(rules: Rules) -> str:
    return _holds(_all(rules))


def valid_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that satisfy all rules.

    A filter drops unknown rows by itself; without the null guard around them, Spark sees
    which columns can no longer be null and does not test them again in later joins.
    """
    return df.filter(_all(rules))


def rejected_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a rule or leave one unknown."""
    return df.filter(f"NOT {is_valid(rules)}")


def quality_report(name: str, raw: DataFrame, deduped: DataFrame, rules: Rules) -> DataFrame:
    """Row counts and the number of broken rules of one table: (dataset, metric, rows)."""
    metrics = {
        "deduplicated": "count(*)",
        "valid": f"count_if({is_valid(rules)})",
        "rejected": f"count_if(NOT {is_valid(rules)})",
        **{f"broken_{rule}": f"count_if(NOT {_holds(check)})" for rule, check in rules.items()},
    }
    counted = deduped.agg(*[F.expr(value).alias(metric) for metric, value in metrics.items()])
    lines = counted.unpivot([], list(metrics), "metric", "rows")
    return (
        raw.agg(F.count("*").alias("rows"))
        .select(F.lit("read").alias("metric"), "rows")
        .unionByName(lines)
        .select(F.lit(name).alias("dataset"), "metric", "rows")
    )
