"""SQL answers to the named queries, for an engine other than Spark.

The statements state the rules in their plainest form, such as a join of each short
order with every later arrival. They check the Spark plans and are not run by them.
"""

from __future__ import annotations

from stockflow.contract import (
    PRODUCT_SCHEMA,
    READINESS_SCHEMA,
    SHIPMENT_SCHEMA,
    TRANSACTION_SCHEMA,
    column_names,
)
from stockflow.functions import columns
from stockflow.operators import generate
from stockflow.sources import driver_tables

AS_OF = f"DATE '{driver_tables.AS_OF}'"


def _source(sql: str) -> str:
    return sql.strip().replace("{part}", "part").replace("{lineitem}", "lineitem")


def _first_per_key(table: str, schema: str) -> str:
    key, *others = column_names(schema)
    order = ", ".join(f"{c} ASC NULLS LAST" for c in others)
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


SHIPMENT_RULES = {
    "shipment_id_present": "shipment_id IS NOT NULL",
    "product_id_present": "product_id IS NOT NULL",
    "warehouse_id_present": "warehouse_id IS NOT NULL",
    "scheduled_date_present": "scheduled_date IS NOT NULL",
    "planned_in_range": "planned_pallet_quantity >= 1 AND planned_pallet_quantity <= 500",
    "type_known": "shipment_type IN ('INBOUND', 'OUTBOUND')",
    "status_known": "shipment_status IN ('SCHEDULED', 'COMPLETED', 'DELAYED', 'CANCELLED')",
}
TRANSACTION_RULES = {
    "transaction_id_present": "transaction_id IS NOT NULL",
    "product_id_present": "product_id IS NOT NULL",
    "warehouse_id_present": "warehouse_id IS NOT NULL",
    "transaction_date_present": "transaction_date IS NOT NULL",
    "quantity_in_range": "abs(pallet_quantity) <= 500",
    "type_known": "transaction_type IN"
    " ('RECEIPT', 'SHIPMENT', 'TRANSFER_IN', 'TRANSFER_OUT', 'PUTAWAY', 'ADJUSTMENT')",
}
PRODUCT_RULES = {
    "product_id_present": "product_id IS NOT NULL",
    "safety_stock_not_negative": "safety_stock_pallets >= 0",
}


def _all(rules: dict[str, str]) -> str:
    return "coalesce(" + " AND ".join(f"({r})" for r in rules.values()) + ", false)"


def _names(schema: str) -> str:
    return ", ".join(column_names(schema))


# Steps shared by the statements, each usable by name after it is defined.
STEPS = {
    "product_reference": _source(driver_tables.PRODUCTS_SQL),
    "shipment_schedule": _source(driver_tables.SHIPMENTS_SQL),
    "inventory_transactions": _source(driver_tables.TRANSACTIONS_SQL),
    "products": _first_per_key("product_reference", PRODUCT_SCHEMA),
    "shipments_once": _first_per_key("shipment_schedule", SHIPMENT_SCHEMA),
    "transactions_once": _first_per_key("inventory_transactions", TRANSACTION_SCHEMA),
    "shipments": f"SELECT * FROM shipments_once WHERE {_all(SHIPMENT_RULES)}",
    "transactions": f"SELECT * FROM transactions_once WHERE {_all(TRANSACTION_RULES)}",
    "stock": f"""
        SELECT product_id, warehouse_id,
               greatest(CAST(sum(pallet_quantity) AS BIGINT), 0) AS current_inventory
        FROM transactions WHERE transaction_date <= {AS_OF}
        GROUP BY product_id, warehouse_id""",
    "events": f"""
        SELECT s.*,
               CASE WHEN shipment_type = 'INBOUND' THEN 0 ELSE 1 END AS event_priority,
               CASE WHEN shipment_type = 'INBOUND' THEN planned_pallet_quantity
                    ELSE -planned_pallet_quantity END AS signed_quantity,
               coalesce(current_inventory, 0) AS current_inventory,
               coalesce(safety_stock_pallets, 0) AS safety_stock_pallets
        FROM shipments s
        LEFT JOIN stock USING (product_id, warehouse_id)
        LEFT JOIN (SELECT product_id, safety_stock_pallets FROM products) USING (product_id)
        WHERE scheduled_date > {AS_OF} AND shipment_status <> 'CANCELLED'""",
    "sequenced": """
        SELECT *,
               CAST(coalesce(sum(signed_quantity) OVER earlier, 0) AS BIGINT) AS prior_net_events,
               row_number() OVER (PARTITION BY product_id, warehouse_id
                                  ORDER BY scheduled_date, event_priority, shipment_id) AS n
        FROM events
        WINDOW earlier AS (PARTITION BY product_id, warehouse_id
                           ORDER BY scheduled_date, event_priority, shipment_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "netted_available": """
        SELECT *, greatest(current_inventory + prior_net_events, 0) AS available_before_order
        FROM sequenced""",
    "clamped_available": """
        SELECT *, current_inventory + prior_net_events
                  - least(coalesce(min(current_inventory + prior_net_events + signed_quantity)
                                   OVER (PARTITION BY product_id, warehouse_id ORDER BY n
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
                  AS available_before_order
        FROM sequenced""",
}
for _policy in ("netted", "clamped"):
    STEPS[f"{_policy}_events"] = f"""
        SELECT *,
               CASE WHEN shipment_type = 'OUTBOUND'
                    THEN greatest(planned_pallet_quantity - available_before_order, 0)
                    ELSE 0 END AS missing_pallets,
               greatest(available_before_order + signed_quantity, 0) AS projected_inventory_after_order
        FROM {_policy}_available"""
STEPS["netted_cover"] = """
    SELECT o.shipment_id, min(i.scheduled_date) AS earliest_inbound_date
    FROM netted_events o
    LEFT JOIN netted_events i
      ON i.product_id = o.product_id AND i.warehouse_id = o.warehouse_id
     AND i.shipment_type = 'INBOUND' AND i.scheduled_date > o.scheduled_date
     AND i.projected_inventory_after_order >= o.planned_pallet_quantity
    WHERE o.missing_pallets > 0
    GROUP BY o.shipment_id"""
STEPS["clamped_cover"] = """
    SELECT o.shipment_id, arg_min(l.scheduled_date, l.n) AS earliest_inbound_date
    FROM clamped_events o
    LEFT JOIN clamped_events l
      ON l.product_id = o.product_id AND l.warehouse_id = o.warehouse_id AND l.n > o.n
     AND o.available_before_order
         + (l.prior_net_events + l.signed_quantity) - (o.prior_net_events + o.signed_quantity)
         >= o.planned_pallet_quantity
    WHERE o.missing_pallets > 0
    GROUP BY o.shipment_id"""
for _policy in ("netted", "clamped"):
    STEPS[f"{_policy}_readiness"] = f"""
        SELECT shipment_id, product_id, warehouse_id, scheduled_date, planned_pallet_quantity,
               available_before_order, projected_inventory_after_order, missing_pallets,
               CASE WHEN missing_pallets = 0 AND projected_inventory_after_order < safety_stock_pallets
                    THEN 'AT_RISK'
                    WHEN missing_pallets = 0 THEN 'READY'
                    WHEN earliest_inbound_date IS NOT NULL THEN 'WAITING_FOR_INBOUND'
                    ELSE 'SHORT' END AS readiness_status,
               CASE WHEN missing_pallets = 0 THEN scheduled_date ELSE earliest_inbound_date END
                 AS earliest_available_date,
               {AS_OF} AS as_of_date
        FROM {_policy}_events LEFT JOIN {_policy}_cover USING (shipment_id)
        WHERE shipment_type = 'OUTBOUND'"""


def _sql(body: str) -> str:
    """`body` with all shared steps in front of it."""
    steps = ",\n".join(f"{name} AS ({text.strip()})" for name, text in STEPS.items())
    return f"WITH {steps}\n{body.strip()}"


def _month(day: str) -> str:
    return f"strftime({day}, '%Y-%m')"


def _quality(name: str, raw: str, once: str, rules: dict[str, str]) -> str:
    valid = _all(rules)
    lines = [
        f"SELECT '{name}' AS dataset, 'read' AS metric, count(*) AS rows FROM {raw}",
        f"SELECT '{name}', 'deduplicated', count(*) FROM {once}",
        f"SELECT '{name}', 'valid', count(*) FROM {once} WHERE {valid}",
        f"SELECT '{name}', 'rejected', count(*) FROM {once} WHERE NOT {valid}",
    ]
    lines += [
        f"SELECT '{name}', 'broken_{rule}', count(*) FROM {once} WHERE NOT coalesce({check}, false)"
        for rule, check in rules.items()
    ]
    return "\nUNION ALL ".join(lines)


# --- generation ------------------------------------------------------------------------


def _draw(number: str, purpose: int, size: int | str, seed: int = generate.DEFAULT_SEED) -> str:
    modulus, factor, step = columns.DRAW_MODULUS, columns.DRAW_FACTOR, columns.DRAW_STEP
    number, start = f"CAST({number} AS BIGINT)", columns.draw_start(seed, purpose)
    first = f"(({number} % {modulus} * {factor} + ({number} >> 31) % {modulus} * {step} + {start}) % {modulus})"
    return f"CAST(({first} * {first} + {step * purpose}) % {modulus} % {size} AS INT)"


def _text_number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _pick(values, index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


WAREHOUSE_CYCLE = ["WH-EAST", "WH-CENTRAL", "WH-WEST"]
LINE_IDS = "(SELECT DISTINCT l_orderkey * 8 + l_linenumber AS id FROM lineitem)"

G = generate
_PLANNED = f"CAST(id % {G.PLANNED_SPAN} + {G.PLANNED_FIRST} AS INT)"
_SCHEDULED = f"id % {G.SCHEDULE_DAYS}"
_FIRST_DAY = f"DATE '{G.FIRST_DAY}'"


def _cycled(values) -> str:
    return _pick(list(values), f"id % {len(list(values))}")


def _ledger_quantity() -> str:
    """Sign and size by type, from the table that the generator has too."""
    lines = []
    for k, (sign, span) in enumerate(G.LEDGER_TYPES.values()):
        factor = "(1 - id % 2 * 2)" if sign is None else sign
        lines.append(f"WHEN {k} THEN {factor} * (id % {span} + 1)")
    return f"CASE id % {len(G.LEDGER_TYPES)} {' '.join(lines)} END"


GEN_PRODUCTS = f"""
    SELECT printf('PRD-%05d', id + 1) AS product_id,
           {_cycled(G.CATEGORIES)} AS product_category,
           {_cycled(G.PACKAGING)} AS packaging_type,
           CAST(id % {G.UNITS_KINDS} * {G.UNITS_STEP} + {G.UNITS_FIRST} AS INT) AS standard_units_per_pallet,
           'AREA-' || (id % {G.AREAS} + 1) AS storage_area,
           CAST(id % {G.SAFETY_SPAN} + {G.SAFETY_FIRST} AS INT) AS safety_stock_pallets
    FROM (SELECT p_partkey AS id FROM part)"""

GEN_SHIPMENTS = f"""
    SELECT printf('SHP-%010d', id + 1) AS shipment_id,
           printf('PRD-%05d', id % {G.DEFAULT_PRODUCTS} + 1) AS product_id,
           {_cycled(WAREHOUSE_CYCLE)} AS warehouse_id,
           {_FIRST_DAY} + CAST({_SCHEDULED} AS INT) AS scheduled_date,
           {_PLANNED} AS planned_pallet_quantity,
           CASE WHEN {_SCHEDULED} <= {G.LAST_COMPLETED_DAY} THEN {_PLANNED} END AS actual_pallet_quantity,
           CASE WHEN id % 100 < {G.INBOUND_PERCENT} THEN 'INBOUND' ELSE 'OUTBOUND' END AS shipment_type,
           CASE WHEN id % {G.CANCELLED_EVERY} = 0 THEN 'CANCELLED' WHEN id % {G.DELAYED_EVERY} = 0 THEN 'DELAYED'
                WHEN {_SCHEDULED} <= {G.LAST_COMPLETED_DAY} THEN 'COMPLETED' ELSE 'SCHEDULED' END AS shipment_status
    FROM {LINE_IDS}"""

GEN_TRANSACTIONS = f"""
    SELECT printf('TX-%012d', id + 1) AS transaction_id,
           CASE WHEN id % 4 < {G.LINKED_OF_FOUR} THEN printf('SHP-%010d', id % {G.DEFAULT_SHIPMENTS} + 1) END AS shipment_id,
           printf('PRD-%05d', id % {G.DEFAULT_PRODUCTS} + 1) AS product_id,
           {_cycled(WAREHOUSE_CYCLE)} AS warehouse_id,
           {_FIRST_DAY} + CAST(id % {G.LEDGER_DAYS} AS INT) AS transaction_date,
           {_cycled(G.LEDGER_TYPES)} AS transaction_type,
           CAST({_ledger_quantity()} AS INT) AS pallet_quantity,
           'LOC-' || (id % {G.LOCATIONS} + 1) AS source_location,
           'LOC-' || (id % {G.LOCATIONS} + 2) AS destination_location
    FROM {LINE_IDS}"""

OPENING = f"""
    SELECT 'TX-O-' || product_id || '-' || w AS transaction_id, CAST(NULL AS VARCHAR) AS shipment_id,
           product_id, warehouse_id, {AS_OF} - 120 AS transaction_date,
           'ADJUSTMENT' AS transaction_type, 35 + {_draw("k", 1, 146)} AS pallet_quantity,
           'OPENING' AS source_location, storage_area AS destination_location
    FROM (SELECT *, {_text_number("product_id")} * 3 + w AS k
          FROM products
          CROSS JOIN (VALUES (0, 'WH-EAST'), (1, 'WH-CENTRAL'), (2, 'WH-WEST')) AS v(w, warehouse_id))"""

MOVEMENTS = f"""
    SELECT 'TX-M-' || shipment_id AS transaction_id, shipment_id, product_id, warehouse_id,
           scheduled_date + lag_days AS transaction_date,
           CASE WHEN shipment_type = 'INBOUND' THEN 'RECEIPT' ELSE 'SHIPMENT' END AS transaction_type,
           CASE WHEN shipment_type = 'INBOUND' THEN actual ELSE -actual END AS pallet_quantity,
           CASE WHEN shipment_type = 'INBOUND' THEN 'DOCK' ELSE storage_area END AS source_location,
           CASE WHEN shipment_type = 'INBOUND' THEN storage_area ELSE 'CUSTOMER' END AS destination_location
    FROM (SELECT *, coalesce(actual_pallet_quantity,
                             greatest(planned_pallet_quantity
                                      + {_pick([-3, -2, -1, 0, 0, 0, 1, 2], _draw("k", 2, 8))}, 0)) AS actual,
                 {_pick([0, 0, 0, 1], _draw("k", 3, 4))} AS lag_days
          FROM (SELECT *, {_text_number("shipment_id")} AS k FROM shipments WHERE shipment_status = 'COMPLETED')
          LEFT JOIN (SELECT product_id, storage_area FROM products) USING (product_id))"""

OPERATIONS = f"""
    SELECT printf('TX-E%012d', id) AS transaction_id, CAST(NULL AS VARCHAR) AS shipment_id,
           product_id, warehouse_id, transaction_date, transaction_type,
           CASE transaction_type WHEN 'PUTAWAY' THEN 0 WHEN 'TRANSFER_OUT' THEN -moved
                WHEN 'ADJUSTMENT' THEN adjusted ELSE moved END AS pallet_quantity,
           'STAGING' AS source_location, storage_area AS destination_location
    FROM (SELECT id, {_draw("id", 4, "(SELECT count(*) FROM products)")} AS drawn_product,
                 CASE WHEN {_draw("id", 5, 100)} < 45 THEN 'PUTAWAY'
                      WHEN {_draw("id", 5, 100)} < 63 THEN 'TRANSFER_IN'
                      WHEN {_draw("id", 5, 100)} < 81 THEN 'TRANSFER_OUT' ELSE 'ADJUSTMENT' END AS transaction_type,
                 {_draw("id", 6, 18)} + 1 AS moved,
                 ({_draw("id", 7, 8)} + 1) * ({_draw("id", 8, 2)} * 2 - 1) AS adjusted,
                 {_pick(WAREHOUSE_CYCLE, _draw("id", 9, 3))} AS warehouse_id,
                 {AS_OF} - 120 + {_draw("id", 10, 121)} AS transaction_date
          FROM (SELECT row_number() OVER () - 1 AS id FROM lineitem)
          WHERE id < (SELECT count(*) FROM inventory_transactions)
                     - 3 * (SELECT count(*) FROM products)
                     - (SELECT count(*) FROM shipments WHERE shipment_status = 'COMPLETED'))
    JOIN (SELECT product_id, storage_area, row_number() OVER (ORDER BY product_id) - 1 AS rank FROM products)
      ON rank = drawn_product"""

# --- statements --------------------------------------------------------------------------

READINESS_COLUMNS = _names(READINESS_SCHEMA)
PROJECTION = """SELECT shipment_id, product_id, warehouse_id, scheduled_date, shipment_type,
       planned_pallet_quantity, current_inventory, available_before_order, missing_pallets,
       projected_inventory_after_order FROM {policy}_events"""
DELAYS = """count(*) FILTER (shipment_status = 'DELAYED') AS delayed_shipments,
       count(*) AS total_shipments"""
VOLUME = """SELECT product_id,
       CAST(sum(CASE WHEN shipment_type = 'INBOUND' THEN planned_pallet_quantity ELSE 0 END) AS BIGINT)
         AS inbound_pallets,
       CAST(sum(CASE WHEN shipment_type = 'OUTBOUND' THEN planned_pallet_quantity ELSE 0 END) AS BIGINT)
         AS outbound_pallets
    FROM shipments WHERE shipment_status <> 'CANCELLED' GROUP BY product_id"""
STATUS_TOTALS = "count(*) AS orders, CAST(sum(missing_pallets) AS BIGINT) AS missing_pallets"

_PUBLISHED = _sql(f"SELECT *, {_month('scheduled_date')} AS event_month FROM netted_readiness")
_TWO_POLICIES = _sql(
    f"""SELECT *, {_month("scheduled_date")} AS event_month FROM netted_readiness
        WHERE warehouse_id <> 'WH-EAST'
        UNION ALL
        SELECT *, {_month("scheduled_date")} FROM clamped_readiness WHERE warehouse_id = 'WH-EAST'"""
)
_QUALITY = _sql(
    _quality("products", "product_reference", "products", PRODUCT_RULES)
    + "\nUNION ALL "
    + _quality("shipments", "shipment_schedule", "shipments_once", SHIPMENT_RULES)
    + "\nUNION ALL "
    + _quality("transactions", "inventory_transactions", "transactions_once", TRANSACTION_RULES)
)
EARLIER = "1999-03-31"

# shipments as lines of CSV: what was sent, and what of it can be read
_CELLS = [f"coalesce(CAST({c} AS VARCHAR), '')" for c in column_names(SHIPMENT_SCHEMA)]
_SENT = {
    "scheduled_date": "CASE pick WHEN 0 THEN '2026-13-45' WHEN 7 THEN '1999-8-4' ELSE coalesce(CAST(scheduled_date AS VARCHAR), '') END",
    "planned_pallet_quantity": "CASE pick WHEN 1 THEN 'abc' WHEN 2 THEN '4.0' WHEN 6 THEN ' 4' ELSE coalesce(CAST(planned_pallet_quantity AS VARCHAR), '') END",
    "actual_pallet_quantity": "CASE pick WHEN 5 THEN 'n/a' ELSE coalesce(CAST(actual_pallet_quantity AS VARCHAR), '') END",
}
_LINE = [_SENT.get(c, f"coalesce({c}, '')") for c in column_names(SHIPMENT_SCHEMA)]
_READ = {
    "scheduled_date": "CASE pick WHEN 0 THEN NULL WHEN 7 THEN DATE '1999-08-04' ELSE scheduled_date END",
    "planned_pallet_quantity": "CASE WHEN pick NOT IN (1, 2, 6) THEN planned_pallet_quantity END",
    "actual_pallet_quantity": "CASE WHEN pick <> 5 THEN actual_pallet_quantity END",
    "shipment_type": "CASE WHEN pick <> 3 THEN shipment_type END",
    "shipment_status": "CASE WHEN pick <> 3 THEN shipment_status END",
}
_RESCUED = _sql(
    f"""SELECT *, CASE WHEN {_all(SHIPMENT_RULES)} THEN 'accepted' ELSE 'rejected' END AS verdict
        FROM (
          SELECT {", ".join(f"{_READ[c]} AS {c}" if c in _READ else c for c in column_names(SHIPMENT_SCHEMA))},
                 CASE WHEN pick < 7 THEN array_to_string(list_concat([{", ".join(_LINE[:6])}],
                   CASE WHEN pick = 3 THEN [] WHEN pick = 4 THEN [{", ".join(_LINE[6:])}, 'more'] ELSE [{", ".join(_LINE[6:])}] END), ',')
                 END AS source_text,
                 CASE pick WHEN 0 THEN 'scheduled_date' WHEN 1 THEN 'planned_pallet_quantity' WHEN 2 THEN 'planned_pallet_quantity'
                   WHEN 3 THEN 'shipment_type,shipment_status' WHEN 4 THEN '(more cells)' WHEN 5 THEN 'actual_pallet_quantity'
                   WHEN 6 THEN 'planned_pallet_quantity' END AS failing_columns
          FROM (SELECT *, {_text_number(" || ',' || ".join(_CELLS))} % 24 AS pick FROM shipment_schedule)
          QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY
            {", ".join(f"{_READ.get(c, c)} ASC NULLS LAST" for c in column_names(SHIPMENT_SCHEMA)[1:])}, coalesce(source_text, '')) = 1)
        WHERE source_text IS NOT NULL OR NOT {_all(SHIPMENT_RULES)}"""
)

_PROMISES = _sql(
    """SELECT product_id, warehouse_id, scheduled_date, shipment_id, running_total,
              greatest(min(running_total) OVER (PARTITION BY product_id, warehouse_id ORDER BY n
                                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS available_to_promise
       FROM (SELECT *, CAST(current_inventory + prior_net_events + signed_quantity AS BIGINT) AS running_total FROM sequenced)"""
)

# lots and orders as stretches of one line per key, joined where they overlap
_LOTS = _sql(
    """SELECT product_id, warehouse_id, lot_id, shipment_id,
              CAST(least(l.till, o.till) - greatest(l.since, o.since) AS BIGINT) AS pallets
       FROM (
         SELECT product_id, warehouse_id, 'OPENING' AS lot_id, 0 AS since, current_inventory AS till FROM stock
         UNION ALL
         SELECT product_id, warehouse_id, shipment_id, till - planned_pallet_quantity, till
         FROM (SELECT *, current_inventory + sum(planned_pallet_quantity) OVER (PARTITION BY product_id, warehouse_id ORDER BY n) AS till
               FROM clamped_events WHERE shipment_type = 'INBOUND')) l
       JOIN (
         SELECT *, till - filled AS since
         FROM (SELECT *, planned_pallet_quantity - missing_pallets AS filled,
                      sum(planned_pallet_quantity - missing_pallets) OVER (PARTITION BY product_id, warehouse_id ORDER BY n) AS till
               FROM clamped_events WHERE shipment_type = 'OUTBOUND')) o USING (product_id, warehouse_id)
       WHERE l.since < o.till AND o.since < l.till AND o.filled > 0 AND l.till > l.since"""
)

ORACLE_SQL: dict[str, str] = {
    "order_readiness": _sql("SELECT * FROM netted_readiness"),
    "order_readiness_by_block": _sql("SELECT * FROM netted_readiness"),
    "order_readiness_clamped": _sql("SELECT * FROM clamped_readiness"),
    "policy_diff": _sql(
        """SELECT shipment_id,
                  n.readiness_status AS netted_readiness_status, n.missing_pallets AS netted_missing_pallets,
                  n.earliest_available_date AS netted_earliest_available_date,
                  c.readiness_status AS clamped_readiness_status, c.missing_pallets AS clamped_missing_pallets,
                  c.earliest_available_date AS clamped_earliest_available_date
           FROM netted_readiness n FULL JOIN clamped_readiness c USING (shipment_id)
           WHERE n.readiness_status IS DISTINCT FROM c.readiness_status
              OR n.missing_pallets IS DISTINCT FROM c.missing_pallets
              OR n.earliest_available_date IS DISTINCT FROM c.earliest_available_date"""
    ),
    "scan_products": _sql("SELECT * FROM product_reference"),
    "scan_shipments": _sql("SELECT * FROM shipment_schedule"),
    "scan_transactions": _sql("SELECT * FROM inventory_transactions"),
    "dedup_products": _sql("SELECT * FROM products"),
    "dedup_shipments": _sql("SELECT * FROM shipments_once"),
    "dedup_transactions": _sql("SELECT * FROM transactions_once"),
    "dedup_null_keys": _sql(
        """SELECT * FROM shipments_once WHERE shipment_id IS NOT NULL
           UNION ALL SELECT * FROM shipment_schedule WHERE shipment_id IS NULL"""
    ),
    "valid_shipments": _sql("SELECT * FROM shipments"),
    "valid_transactions": _sql("SELECT * FROM transactions"),
    "rejected_shipments": _sql(f"SELECT * FROM shipments_once WHERE NOT {_all(SHIPMENT_RULES)}"),
    "rejected_transactions": _sql(f"SELECT * FROM transactions_once WHERE NOT {_all(TRANSACTION_RULES)}"),
    "split_counts": _sql(
        f"""SELECT 'shipments' AS dataset, count(*) AS deduplicated,
                   count(*) FILTER ({_all(SHIPMENT_RULES)}) AS valid,
                   count(*) FILTER (NOT {_all(SHIPMENT_RULES)}) AS rejected FROM shipments_once
            UNION ALL
            SELECT 'transactions', count(*), count(*) FILTER ({_all(TRANSACTION_RULES)}),
                   count(*) FILTER (NOT {_all(TRANSACTION_RULES)}) FROM transactions_once"""
    ),
    "quality_report": _QUALITY,
    "current_inventory": _sql("SELECT * FROM stock"),
    "future_events": _sql(f"SELECT {_names(SHIPMENT_SCHEMA)} FROM events"),
    "signed_events": _sql(
        """SELECT shipment_id, shipment_type, planned_pallet_quantity, event_priority, signed_quantity
           FROM events"""
    ),
    "events_enriched": _sql(
        """SELECT shipment_id, product_id, warehouse_id, scheduled_date, event_priority, signed_quantity,
                  current_inventory, safety_stock_pallets FROM events"""
    ),
    "running_net": _sql("SELECT shipment_id, signed_quantity, prior_net_events FROM sequenced"),
    "projected_inventory": _sql(PROJECTION.format(policy="netted")),
    "clamped_ledger": _sql(PROJECTION.format(policy="clamped")),
    "short_orders": _sql(
        "SELECT shipment_id, planned_pallet_quantity, missing_pallets FROM netted_events WHERE missing_pallets > 0"
    ),
    "availability_netted": _sql("SELECT * FROM netted_cover"),
    "availability_clamped": _sql("SELECT * FROM clamped_cover"),
    "readiness_summary": _sql(
        f"SELECT readiness_status, {STATUS_TOTALS} FROM netted_readiness GROUP BY readiness_status"
    ),
    "readiness_by_month": _sql(
        f"""SELECT warehouse_id, {_month("scheduled_date")} AS event_month, readiness_status, {STATUS_TOTALS}
            FROM netted_readiness GROUP BY ALL"""
    ),
    "attention_orders": _sql(
        """SELECT shipment_id, product_id, warehouse_id, scheduled_date, planned_pallet_quantity,
                  missing_pallets, readiness_status, earliest_available_date
           FROM netted_readiness WHERE readiness_status IN ('AT_RISK', 'SHORT', 'WAITING_FOR_INBOUND')
           ORDER BY scheduled_date, missing_pallets DESC, shipment_id"""
    ),
    "shortage_by_warehouse": _sql(
        """SELECT warehouse_id,
                  count(*) FILTER (readiness_status IN ('SHORT', 'WAITING_FOR_INBOUND')) AS constrained_orders,
                  CAST(sum(missing_pallets) AS BIGINT) AS missing_pallets
           FROM netted_readiness GROUP BY warehouse_id ORDER BY missing_pallets DESC, warehouse_id"""
    ),
    "top_product_volume": _sql(
        f"SELECT * FROM ({VOLUME}) ORDER BY inbound_pallets + outbound_pallets DESC, product_id LIMIT 20"
    ),
    "top_adjustments": _sql(
        """SELECT product_id, count(*) AS adjustment_events,
                  CAST(sum(abs(pallet_quantity)) AS BIGINT) AS adjusted_pallets
           FROM transactions WHERE transaction_type = 'ADJUSTMENT' GROUP BY product_id
           ORDER BY adjusted_pallets DESC, product_id LIMIT 20"""
    ),
    "delay_rate": _sql(
        f"""SELECT *, CAST((20000 * delayed_shipments + total_shipments) // (2 * total_shipments) AS DOUBLE)
                      / 100.0 AS delay_rate_pct
            FROM (SELECT warehouse_id, shipment_type, {DELAYS} FROM shipments GROUP BY ALL)"""
    ),
    "kpi_status_counts": _sql(
        """SELECT s.readiness_status, count(r.shipment_id) AS orders
           FROM (VALUES ('READY'), ('AT_RISK'), ('WAITING_FOR_INBOUND'), ('SHORT')) AS s(readiness_status)
           LEFT JOIN netted_readiness r USING (readiness_status) GROUP BY s.readiness_status"""
    ),
    "kpi_totals": _sql(
        """SELECT count(*) AS orders_evaluated,
                  count(*) FILTER (readiness_status <> 'READY') AS orders_needing_attention,
                  CAST(coalesce(sum(missing_pallets), 0) AS BIGINT) AS missing_pallets
           FROM netted_readiness"""
    ),
    "kpi_top10_movement": _sql(
        f"""SELECT *, inbound_pallets + outbound_pallets AS total_pallets FROM ({VOLUME})
            ORDER BY total_pallets DESC, product_id LIMIT 10"""
    ),
    "kpi_dataset_sizes": _sql(
        """SELECT 'transactions' AS dataset, count(*) AS size FROM inventory_transactions
           UNION ALL SELECT 'shipments', count(*) FROM shipment_schedule
           UNION ALL SELECT 'products', count(*) FROM product_reference
           UNION ALL SELECT 'warehouses', count(DISTINCT warehouse_id) FROM shipment_schedule"""
    ),
    "inventory_trend": _sql(
        f"""SELECT warehouse_id, transaction_date, net_pallets,
                   CAST(sum(net_pallets) OVER (PARTITION BY warehouse_id ORDER BY transaction_date) AS BIGINT)
                     AS ledger_balance
            FROM (SELECT warehouse_id, transaction_date, CAST(sum(pallet_quantity) AS BIGINT) AS net_pallets
                  FROM transactions WHERE transaction_date <= {AS_OF} GROUP BY ALL)"""
    ),
    "top_shortages": _sql(
        """SELECT product_id, count(*) AS short_orders, CAST(sum(missing_pallets) AS BIGINT) AS missing_pallets
           FROM netted_readiness WHERE missing_pallets > 0 GROUP BY product_id
           ORDER BY missing_pallets DESC, product_id LIMIT 20"""
    ),
    "top_delays": _sql(
        f"""SELECT * FROM (SELECT product_id, {DELAYS} FROM shipments GROUP BY product_id)
            WHERE delayed_shipments > 0 ORDER BY delayed_shipments DESC, product_id LIMIT 20"""
    ),
    "key_profile": _sql(
        """SELECT count(*) AS keys, CAST(sum(c) AS BIGINT) AS events, max(c) AS largest_key,
                  CAST(sum(c) AS DOUBLE) / count(*) AS average_key
           FROM (SELECT product_id, warehouse_id, count(*) AS c FROM events GROUP BY ALL)"""
    ),
    "partition_profile": _sql(
        f"""SELECT warehouse_id, event_month, CAST(sum(c) AS BIGINT) AS shipments, count(*) AS products,
                   max(c) AS largest_product, CAST(sum(c) AS DOUBLE) / count(*) AS average_product
            FROM (SELECT warehouse_id, {_month("scheduled_date")} AS event_month, product_id, count(*) AS c
                  FROM shipments GROUP BY ALL)
            GROUP BY warehouse_id, event_month"""
    ),
    "plan_vs_posted": _sql(
        """SELECT shipment_id, shipment_type, planned_pallet_quantity, actual_pallet_quantity,
                  coalesce(postings, 0) AS postings,
                  coalesce(posted_pallets, 0) AS posted_pallets
           FROM shipments
           LEFT JOIN (SELECT shipment_id, count(*) AS postings,
                             CAST(sum(pallet_quantity) AS BIGINT) AS posted_pallets
                      FROM transactions WHERE shipment_id IS NOT NULL GROUP BY shipment_id)
             USING (shipment_id)
           WHERE shipment_status = 'COMPLETED'"""
    ),
    "overdue_open_shipments": _sql(
        f"""SELECT * FROM shipments
            WHERE shipment_status IN ('SCHEDULED', 'DELAYED') AND scheduled_date <= {AS_OF}"""
    ),
    "volume_by_warehouse": _sql(
        f"""SELECT warehouse_id, shipment_type, {_month("scheduled_date")} AS event_month,
                   count(*) AS shipments, CAST(sum(planned_pallet_quantity) AS BIGINT) AS planned_pallets
            FROM shipments WHERE shipment_status <> 'CANCELLED' GROUP BY ALL"""
    ),
    "publish_readiness": _PUBLISHED,
    # partitions without a row in the update keep the first policy
    "publish_incremental": _TWO_POLICIES,
    "lot_matching": _LOTS,
    "available_to_promise": _PROMISES,
    "quarantine_rescued": _RESCUED,
    "publish_snapshot": _PUBLISHED,
    "snapshot_as_of": _PUBLISHED.replace(AS_OF, f"DATE '{EARLIER}'"),
    "snapshot_replace": _TWO_POLICIES,
    "published_quality": _QUALITY,
    "incremental_inventory": _sql("SELECT * FROM stock"),
    "incremental_readiness": _PUBLISHED,
    "publish_balance": _sql("SELECT * FROM stock"),
    "quarantine_shipments_sink": _sql(f"SELECT * FROM shipments_once WHERE NOT {_all(SHIPMENT_RULES)}"),
    "quarantine_transactions_sink": _sql(
        f"SELECT * FROM transactions_once WHERE NOT {_all(TRANSACTION_RULES)}"
    ),
    "export_csv": _sql("SELECT * FROM clamped_readiness"),
    "gen_products": _sql(GEN_PRODUCTS),
    "gen_shipments": _sql(GEN_SHIPMENTS),
    "gen_transactions": _sql(GEN_TRANSACTIONS),
    "gen_products_sink": _sql(GEN_PRODUCTS),
    "gen_shipments_sink": _sql(
        f"SELECT *, {_month('scheduled_date')} AS event_month FROM ({GEN_SHIPMENTS})"
    ),
    "gen_transactions_sink": _sql(
        f"SELECT *, {_month('transaction_date')} AS event_month FROM ({GEN_TRANSACTIONS})"
    ),
    "opening_balances": _sql(OPENING),
    "movements_from_shipments": _sql(MOVEMENTS),
    "gen_ledger": _sql(f"{OPENING} UNION ALL {MOVEMENTS} UNION ALL {OPERATIONS}"),
}

# the same questions of the other policy, of the whole job and of published tables
for _name in ("kpi_status_counts", "kpi_totals"):
    ORACLE_SQL[f"{_name}_clamped"] = ORACLE_SQL[_name].replace("netted_readiness r", "clamped_readiness r").replace(
        "FROM netted_readiness", "FROM clamped_readiness"
    )
ORACLE_SQL["job_summary"] = ORACLE_SQL["readiness_summary"]
for _name, _asked in {
    "published_attention": "attention_orders",
    "published_shortage": "shortage_by_warehouse",
    "published_volume": "top_product_volume",
    "published_adjustments": "top_adjustments",
    "published_delay_rate": "delay_rate",
}.items():
    ORACLE_SQL[_name] = ORACLE_SQL[_asked]
