"""Column contract of the stock, schedule and readiness tables.

Everything in this module is a fixed value of the data contract: column names,
column types, enum values and limits that every producer and consumer of these
tables shares.
"""

# --- fixed values: input schemas -------------------------------------------

PRODUCT_SCHEMA = """
    product_id string,
    product_category string,
    packaging_type string,
    standard_units_per_pallet int,
    storage_area string,
    safety_stock_pallets int
"""

SHIPMENT_SCHEMA = """
    shipment_id string,
    product_id string,
    warehouse_id string,
    scheduled_date date,
    planned_pallet_quantity int,
    actual_pallet_quantity int,
    shipment_type string,
    shipment_status string
"""

TRANSACTION_SCHEMA = """
    transaction_id string,
    shipment_id string,
    product_id string,
    warehouse_id string,
    transaction_date date,
    transaction_type string,
    pallet_quantity int,
    source_location string,
    destination_location string
"""

READINESS_SCHEMA = """
    shipment_id string,
    product_id string,
    warehouse_id string,
    scheduled_date date,
    planned_pallet_quantity int,
    available_before_order bigint,
    projected_inventory_after_order bigint,
    missing_pallets bigint,
    readiness_status string,
    earliest_available_date date,
    as_of_date date
"""

INVENTORY_SCHEMA = """
    product_id string,
    warehouse_id string,
    current_inventory bigint
"""

# --- fixed values: table names ---------------------------------------------

PRODUCTS = "product_reference"
SHIPMENTS = "shipment_schedule"
TRANSACTIONS = "inventory_transactions"
READINESS = "order_readiness"
INVENTORY = "current_inventory"

# --- fixed values: enums and limits ----------------------------------------

INBOUND = "INBOUND"
OUTBOUND = "OUTBOUND"
SHIPMENT_TYPES = (INBOUND, OUTBOUND)

CANCELLED = "CANCELLED"
DELAYED = "DELAYED"
SHIPMENT_STATUSES = ("SCHEDULED", "COMPLETED", "DELAYED", "CANCELLED")

TRANSACTION_TYPES = (
    "RECEIPT",
    "SHIPMENT",
    "TRANSFER_IN",
    "TRANSFER_OUT",
    "PUTAWAY",
    "ADJUSTMENT",
)

READY = "READY"
AT_RISK = "AT_RISK"
WAITING = "WAITING_FOR_INBOUND"
SHORT = "SHORT"
READINESS_STATUSES = (READY, AT_RISK, WAITING, SHORT)

WAREHOUSES = ("WH-EAST", "WH-CENTRAL", "WH-WEST")

MIN_PLANNED = 1
MAX_PALLETS = 500
DEFAULT_AS_OF = "2026-08-01"

# --- shared shorthands ------------------------------------------------------

STOCK_KEY = ["product_id", "warehouse_id"]


def column_names(schema: str) -> list[str]:
    """Column names of one of the schema texts above, in order."""
    return [field.split()[0] for field in schema.split(",")]

# --- folders of published tables ---------------------------------------------

# above the partitions of tables whose rows were judged while they were written
VERDICT = "is_valid"
