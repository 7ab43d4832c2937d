"""Fixed schemas: source tables, event log, archive, and current-state specs.

Schemas are DDL strings, which every Spark reader accepts as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

# Column names, types and order of the public table layouts.

SOURCE_TABLES = {
    "customers": (
        "id string, email string, full_name string, country string,"
        " created_at timestamp, updated_at timestamp"
    ),
    "products": (
        "id string, sku string, name string, category string, price_cents bigint,"
        " stock_qty int, created_at timestamp, updated_at timestamp"
    ),
    "orders": (
        "id string, customer_id string, total_cents bigint, status string,"
        " payment_method string, ship_country string, created_at timestamp, updated_at timestamp"
    ),
    "order_items": (
        "id string, order_id string, product_id string, quantity int,"
        " unit_price_cents bigint, created_at timestamp"
    ),
}

HOT_LOG = (
    "event_key string, source_table string, operation string, record_id string,"
    " event_data variant, commit_timestamp timestamp_ntz, ingested_at timestamp_ntz"
)

COLD_LOG = (
    "event_key string, source_table string, operation string, record_id string,"
    " event_data string, commit_timestamp timestamp_ntz, ingested_at timestamp_ntz,"
    " snapshot_id bigint"
)

SNAPSHOT_LOG = (
    "snapshot_id bigint, committed_at timestamp_ntz, operation string, summary map<string,string>"
)

SOLD = ("paid", "shipped", "delivered")


@dataclass(frozen=True)
class TableSpec:
    """How one source table's payload becomes a typed current-state row."""

    source_table: str
    key: str
    fields: tuple[tuple[str, str], ...]


ORDERS = TableSpec(
    "orders",
    "order_id",
    (
        ("customer_id", "string"),
        ("total_cents", "bigint"),
        ("status", "string"),
        ("payment_method", "string"),
        ("ship_country", "string"),
    ),
)

CUSTOMERS = TableSpec(
    "customers",
    "customer_id",
    (("email", "string"), ("full_name", "string"), ("country", "string")),
)

PRODUCTS = TableSpec(
    "products",
    "product_id",
    (
        ("sku", "string"),
        ("name", "string"),
        ("category", "string"),
        ("price_cents", "bigint"),
        ("stock_qty", "int"),
    ),
)

ORDER_ITEMS = TableSpec(
    "order_items",
    "order_item_id",
    (
        ("order_id", "string"),
        ("product_id", "string"),
        ("quantity", "int"),
        ("unit_price_cents", "bigint"),
    ),
)

STATE_SPECS = (ORDERS, CUSTOMERS, PRODUCTS, ORDER_ITEMS)
