"""The end-to-end tables: cleaned layers, star schema, business aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.catalog.reference_sql import (
    BATCH_TS,
    layer,
    mask,
    money,
    ratio,
    rnd,
    to_bool,
    with_layers,
)
from shopgrain.catalog.registry import query
from shopgrain.operators.quality import kept_rows
from shopgrain.plans import daily, gold, silver, star
from shopgrain.plans.declared import SILVER_TESTS
from shopgrain.session import materialize, scratch_path
from shopgrain.sources.conform import FIRST_LOAD_TS, Retail, as_text, ntz


def latest_by(key: str, table: str) -> str:
    return (
        f"(SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} "
        f"ORDER BY _ingested_at DESC) AS rn FROM {table}) WHERE rn = 1)"
    )


@query("silver_orders", layer("silver_orders"))
def silver_orders(t: Retail):
    return t.silver_orders


@query("silver_customers", layer("silver_customers"))
def silver_customers(t: Retail):
    return t.silver_customers


@query("silver_products", layer("silver_products"))
def silver_products(t: Retail):
    return t.silver_products


@query("silver_inventory", layer("silver_inventory"))
def silver_inventory(t: Retail):
    return t.silver_inventory


EXPECT_MARGIN = ratio(
    f"{money('net_amount')} - {money('gross_amount')} * CAST(0.6 AS DECIMAL(2,1))",
    money("net_amount"),
)


@query(
    "silver_orders_expect",
    with_layers(
        f"""SELECT * REPLACE (CAST(order_date AS DATE) AS order_date),
          {rnd(EXPECT_MARGIN, 4)} AS margin_pct, FALSE AS is_deleted, {BATCH_TS} AS _updated_at
        FROM {latest_by("order_id", "bronze_orders")}
        WHERE order_id IS NOT NULL AND quantity > 0 AND net_amount > 0""",
        "bronze_orders",
    ),
)
def silver_orders_expect(t: Retail):
    return kept_rows(silver.expect_orders(t.bronze_orders, t.batch_ts), silver.ORDER_RULES)


@query(
    "silver_customers_expect",
    with_layers(
        f"""SELECT * REPLACE (CAST(join_date AS DATE) AS join_date, {to_bool("is_active")} AS is_active),
          concat_ws(' ', first_name, last_name) AS full_name, {mask("email")} AS email_masked
        FROM {latest_by("customer_id", "bronze_customers")} WHERE customer_id IS NOT NULL""",
        "bronze_customers",
    ),
)
def silver_customers_expect(t: Retail):
    return kept_rows(silver.expect_customers(t.bronze_customers), silver.CUSTOMER_RULES)


PRODUCT_MARGIN = ratio(f"{money('retail_price')} - {money('cost_price')}", "retail_price")


@query(
    "silver_products_expect",
    with_layers(
        f"""SELECT * REPLACE ({to_bool("is_active")} AS is_active),
          {rnd(PRODUCT_MARGIN, 4)} AS margin_pct
        FROM {latest_by("product_id", "bronze_products")} WHERE product_id IS NOT NULL""",
        "bronze_products",
    ),
)
def silver_products_expect(t: Retail):
    return kept_rows(silver.expect_products(t.bronze_products), silver.PRODUCT_RULES)


@query(
    "silver_inventory_expect",
    with_layers(
        f"""SELECT * REPLACE (CAST(snapshot_date AS DATE) AS snapshot_date,
          {to_bool("is_below_reorder")} AS is_below_reorder)
        FROM {latest_by("inventory_id", "bronze_inventory")} WHERE inventory_id IS NOT NULL""",
        "bronze_inventory",
    ),
)
def silver_inventory_expect(t: Retail):
    return kept_rows(silver.expect_inventory(t.bronze_inventory), silver.INVENTORY_RULES)


@query("dim_customer", layer("dim_customer"))
def dim_customer(t: Retail):
    return t.dim_customer


@query("dim_product", layer("dim_product"))
def dim_product(t: Retail):
    return t.dim_product


SPINE_SQL = (
    "SELECT CAST(unnest(generate_series(MIN(CAST(o_orderdate AS DATE)), "
    "MAX(CAST(o_orderdate AS DATE)) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders"
)


def order_days(t: Retail, with_last: bool = False):
    """Days from the first to the last order date; a spine's end is excluded, unless asked for."""
    bounds = t.table("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"),
        F.date_add(F.to_date(F.max("o_orderdate")), int(with_last)).alias("last"),
    )
    return star.date_spine(bounds, "first", "last")


@query("generate_date_spine", SPINE_SQL)
def generate_date_spine(t: Retail):
    return order_days(t)


@query(
    "dim_date",
    f"""SELECT date_day AS date_key, date_day AS full_date, CAST(year(date_day) AS INTEGER) AS year,
      CAST(quarter(date_day) AS INTEGER) AS quarter, CAST(month(date_day) AS INTEGER) AS month,
      strftime(date_day, '%B') AS month_name, CAST(day(date_day) AS INTEGER) AS day_of_month,
      CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week, strftime(date_day, '%A') AS day_name,
      strftime(date_day, '%Y-%m') AS year_month,
      CAST(year(date_day) AS VARCHAR) || '-Q' || CAST(quarter(date_day) AS VARCHAR) AS year_quarter,
      dayofweek(date_day) IN (0, 6) AS is_weekend, month(date_day) IN (11, 12) AS is_holiday_season
    FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE
      AS date_day FROM orders)""",
)
def dim_date(t: Retail):
    """A row for every day with orders, the last one included."""
    return star.dim_date(order_days(t, with_last=True))


@query("fact_orders", layer("fact_orders"))
def fact_orders(t: Retail):
    return t.fact_orders


@query("gold_daily_sales", layer("gold_daily_sales"))
def gold_daily_sales(t: Retail):
    sold = materialize(t.order_profit.select(*gold.DAILY_COLUMNS), "order-profit")
    return gold.daily_sales(sold, orders_unique=True)


@query("gold_product_performance", layer("gold_product_performance"))
def gold_product_performance(t: Retail):
    return gold.product_performance(t.order_profit, t.dim_product, orders_unique=True)


@query("gold_customer_rfm", layer("gold_customer_rfm"))
def gold_customer_rfm(t: Retail):
    return gold.customer_rfm(t.order_lines, t.dim_customer, t.as_of, orders_unique=True)


@query("gold_inventory_health", layer("gold_inventory_health"))
def gold_inventory_health(t: Retail):
    return gold.inventory_health(
        t.silver_inventory, t.dim_product, as_text(t.hot_products)
    )


@query(
    "pii_masked_customers",
    with_layers(
        "SELECT * EXCLUDE (first_name, last_name, full_name, email, email_masked), "
        "email_masked AS email FROM silver_customers",
        "silver_customers",
    ),
)
def pii_masked_customers(t: Retail):
    return gold.masked_customers(t.silver_customers)


COUNTED = (
    "silver_orders",
    "silver_customers",
    "silver_products",
    "silver_inventory",
    "dim_customer",
    "dim_product",
    "fact_orders",
    "gold_daily_sales",
    "gold_product_performance",
    "gold_customer_rfm",
    "gold_inventory_health",
)
N_TESTS = sum(len(tests) for tests in SILVER_TESTS.values())


@query(
    "daily_refresh",
    with_layers(
        " UNION ALL ".join(f"SELECT '{c}' AS table_name, COUNT(*) AS row_count FROM {c}" for c in COUNTED)
        + f""" UNION ALL SELECT 'scd_customers', COUNT(*) FROM silver_customers
        UNION ALL SELECT 'quality_report', CAST({N_TESTS} AS BIGINT)
        UNION ALL SELECT 'gold_forecast', CAST(90 AS BIGINT)
        UNION ALL SELECT 'dim_date', date_diff('day', MIN(order_date), MAX(order_date)) + 1
          FROM silver_orders""",
        *COUNTED,
    ),
)
def daily_refresh(t: Retail):
    """The daily job from empty: every table it writes, with its row count."""
    bronze = {f: t.bronze(f) for f in ("orders", "customers", "products", "inventory")}
    root = scratch_path(t.spark, "daily")
    tables = daily.refresh(t.spark, bronze, root, t.as_of, t.batch_ts)
    counts = [
        t.spark.read.parquet(f"{root}/{name}")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in tables
    ]
    return reduce(DataFrame.unionByName, counts)


@query("daily_refresh_incremental", layer("gold_daily_sales"))
def daily_refresh_incremental(t: Retail):
    """The first load, then a second run that merges the rows loaded since: the daily report, row by row."""
    bronze = {f: t.bronze(f) for f in ("orders", "customers", "products", "inventory")}
    early = {f: rows.where(F.col("_ingested_at") == ntz(FIRST_LOAD_TS)) for f, rows in bronze.items()}
    first, second = (scratch_path(t.spark, n) for n in ("daily-first", "daily-second"))
    daily.refresh(t.spark, early, first, t.as_of, t.batch_ts)
    daily.refresh(t.spark, bronze, second, t.as_of, t.batch_ts, previous=first)
    return t.spark.read.parquet(f"{second}/gold_daily_sales")
