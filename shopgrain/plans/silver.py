"""Cleaned, typed, keyed tables built from the raw feeds.

Two families: the plain cleaners, and those that leave bad rows to the quality rules: ``checkable_*`` types
and adds columns row by row, for batches and streams alike, ``expect_*`` reduces a batch to one row per key first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import as_money, email_mask, ratio, rounded, to_bool, to_day
from shopgrain.functions.labels import age_band, discount_tier
from shopgrain.operators.changes import latest_per_key
from shopgrain.operators.quality import Rule

# Fixed values, as the tables' users know them: the assumed share of cost in the gross amount where no
# product cost is known, and the names and conditions of the rules.
ASSUMED_COST_SHARE = 0.6

ORDER_RULES = (
    Rule("valid_order_id", "order_id IS NOT NULL", "drop"),
    Rule("valid_quantity", "quantity > 0", "drop"),
    Rule("valid_amount", "net_amount > 0", "drop"),
    Rule("valid_order_date", "order_date IS NOT NULL", "warn"),
    Rule("valid_discount", "discount_pct BETWEEN 0 AND 1", "warn"),
)
CUSTOMER_RULES = (
    Rule("valid_customer_id", "customer_id IS NOT NULL", "drop"),
    Rule("valid_age", "age BETWEEN 18 AND 100", "warn"),
    Rule("valid_email", "email LIKE '%@%.%'", "warn"),
)
PRODUCT_RULES = (
    Rule("valid_product_id", "product_id IS NOT NULL", "drop"),
    Rule("positive_cost", "cost_price > 0", "warn"),
    Rule("positive_retail", "retail_price > 0", "warn"),
)
INVENTORY_RULES = (
    Rule("valid_inventory_id", "inventory_id IS NOT NULL", "drop"),
    Rule("non_negative_stock", "quantity_on_hand >= 0", "warn"),
)


def typed_orders(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "order_id",
        "customer_id",
        "product_id",
        F.col("quantity").try_cast("int").alias("quantity"),
        *[
            F.col(c).try_cast("double").alias(c)
            for c in ("unit_price", "discount_pct", "gross_amount", "net_amount")
        ],
        to_day("order_date").alias("order_date"),
        "channel",
        "region",
        "status",
        F.col("ship_days").try_cast("int").alias("ship_days"),
        "_ingested_at",
    )


def order_attributes() -> dict[str, Column]:
    """What follows from a cleaned order's own columns, row by row: cheaper to add again than to shuffle."""
    return {
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
        "order_month_key": F.date_format("order_date", "yyyy-MM"),
        "day_of_week": F.dayofweek("order_date"),
        "avg_unit_net_price": rounded(ratio(as_money("net_amount"), "quantity"), 2),
        "discount_tier": discount_tier("discount_pct"),
    }


def silver_orders(bronze: DataFrame, batch_ts: Column) -> DataFrame:
    return (
        typed_orders(bronze)
        .where("order_id IS NOT NULL AND quantity > 0 AND net_amount > 0")
        .withColumns({"_updated_at": batch_ts, "is_deleted": F.lit(False), **order_attributes()})
    )


def silver_customers(bronze: DataFrame, as_of: Column, batch_ts: Column) -> DataFrame:
    return (
        bronze.where("customer_id IS NOT NULL")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
            "email",
            email_mask("email").alias("email_masked"),
            F.col("age").try_cast("int").alias("age"),
            "city",
            "state",
            "segment",
            to_day("join_date").alias("join_date"),
            to_bool("is_active").alias("is_active"),
            "_ingested_at",
            batch_ts.alias("_updated_at"),
        )
        .withColumns(
            {
                "age_band": age_band("age"),
                "days_since_join": F.datediff(as_of, F.col("join_date")),
            }
        )
    )


def silver_products(bronze: DataFrame, batch_ts: Column) -> DataFrame:
    typed = bronze.withColumns(
        {c: F.col(c).try_cast("double") for c in ("cost_price", "retail_price")}
    )
    margin = as_money("retail_price") - as_money("cost_price")
    return typed.where("product_id IS NOT NULL AND cost_price > 0").select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "cost_price",
        "retail_price",
        rounded(ratio(margin, "retail_price"), 4).alias("margin_pct"),
        "supplier_id",
        to_bool("is_active").alias("is_active"),
        "_ingested_at",
        batch_ts.alias("_updated_at"),
    )


def silver_inventory(bronze: DataFrame, batch_ts: Column) -> DataFrame:
    on_hand = F.col("quantity_on_hand").try_cast("int")
    return bronze.where("inventory_id IS NOT NULL").select(
        "inventory_id",
        "product_id",
        "warehouse_id",
        to_day("snapshot_date").alias("snapshot_date"),
        on_hand.alias("quantity_on_hand"),
        F.col("reorder_level").try_cast("int").alias("reorder_level"),
        to_bool("is_below_reorder").alias("is_below_reorder"),
        F.coalesce(on_hand == 0, F.lit(False)).alias("is_out_of_stock"),
        "_ingested_at",
        batch_ts.alias("_updated_at"),
    )


def _one_row_per_key(bronze: DataFrame, key: str) -> DataFrame:
    return latest_per_key(bronze, [key], [F.desc_nulls_last("_ingested_at")])


def checkable_orders(bronze: DataFrame, batch_ts: Column) -> DataFrame:
    profit = as_money("net_amount") - as_money("gross_amount") * F.lit(
        str(ASSUMED_COST_SHARE)
    ).cast("decimal(2,1)")
    return bronze.withColumns(
        {
            "order_date": to_day("order_date"),
            "discount_pct": F.col("discount_pct").try_cast("double"),
            "margin_pct": rounded(ratio(profit, as_money("net_amount")), 4),
            "is_deleted": F.lit(False),
            "_updated_at": batch_ts,
        }
    )


def checkable_customers(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "join_date": to_day("join_date"),
            "is_active": to_bool("is_active"),
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "email_masked": email_mask("email"),
        }
    )


def checkable_products(bronze: DataFrame) -> DataFrame:
    margin = as_money("retail_price") - as_money("cost_price")
    return bronze.withColumns(
        {
            "is_active": to_bool("is_active"),
            "margin_pct": rounded(ratio(margin, "retail_price"), 4),
        }
    )


def checkable_inventory(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "snapshot_date": to_day("snapshot_date"),
            "is_below_reorder": to_bool("is_below_reorder"),
        }
    )


def expect_orders(bronze: DataFrame, batch_ts: Column) -> DataFrame:
    return checkable_orders(_one_row_per_key(bronze, "order_id"), batch_ts)


def expect_customers(bronze: DataFrame) -> DataFrame:
    return checkable_customers(_one_row_per_key(bronze, "customer_id"))


def expect_products(bronze: DataFrame) -> DataFrame:
    return checkable_products(_one_row_per_key(bronze, "product_id"))


def expect_inventory(bronze: DataFrame) -> DataFrame:
    return checkable_inventory(_one_row_per_key(bronze, "inventory_id"))
