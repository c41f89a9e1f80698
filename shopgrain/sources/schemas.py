"""Raw feed layouts. Column names, order and types of the incoming CSV files."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

ORDERS = (
    "order_id string, customer_id string, product_id string, quantity int, unit_price double, "
    "discount_pct double, gross_amount double, net_amount double, order_date string, "
    "channel string, region string, status string, ship_days int"
)
PRODUCTS = (
    "product_id string, product_name string, category string, subcategory string, "
    "cost_price double, retail_price double, supplier_id string, is_active string"
)
CUSTOMERS = (
    "customer_id string, first_name string, last_name string, email string, age int, "
    "city string, state string, segment string, join_date string, is_active string"
)
INVENTORY = (
    "inventory_id string, product_id string, warehouse_id string, snapshot_date string, "
    "quantity_on_hand int, reorder_level int, is_below_reorder string"
)
FEEDS = {
    "orders": ORDERS,
    "products": PRODUCTS,
    "customers": CUSTOMERS,
    "inventory": INVENTORY,
}
KEYS = {
    "orders": "order_id",
    "products": "product_id",
    "customers": "customer_id",
    "inventory": "inventory_id",
}


def struct(columns: str) -> StructType:
    """'name type, name type' as a schema; needs no running session."""
    schema = StructType()
    for column in columns.split(","):
        name, type_name = column.split()
        schema.add(name, "integer" if type_name == "int" else type_name)
    return schema


def names(columns: str) -> list[str]:
    return struct(columns).fieldNames()


def all_strings(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])
