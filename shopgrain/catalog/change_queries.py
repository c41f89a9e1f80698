"""Incremental loads, CDC merges, history and change feeds on the conformed tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.catalog.reference_sql import BATCH_TS, LOADS, layer, with_layers
from shopgrain.catalog.registry import query
from shopgrain.operators import changes, increments, merge
from shopgrain.operators.changes import cdc_tag
from shopgrain.plans import gold, silver, star
from shopgrain.plans.daily import snapshot
from shopgrain.plans.declared import SNAPSHOT_CHECKS
from shopgrain.session import materialize, scratch_path
from shopgrain.sources.conform import FIRST_LOAD_TS, Retail, as_text, ntz

CDC_TS = "2001-08-03 00:00:00"
CDC_SQL_TS = f"TIMESTAMP '{CDC_TS}'"
#: The last day that the earlier image of the orders knows about.
KNOWN_UNTIL = dt.date(2001, 4, 30)
#: Placed after that day; or shipped after it, so that the earlier image has no shipping time yet.
NEW = f"coalesce(CAST(order_date AS DATE) > DATE '{KNOWN_UNTIL}', FALSE)"
SHIPPED = f"coalesce(CAST(order_date AS DATE) + ship_days > DATE '{KNOWN_UNTIL}', FALSE) AND NOT {NEW}"


@query(
    "incremental_high_water",
    with_layers(
        f"""SELECT order_id, _ingested_at FROM bronze_orders WHERE _ingested_at >
          (SELECT MAX(_ingested_at) FROM bronze_orders WHERE _ingested_at = {LOADS[0]})""",
        "bronze_orders",
    ),
)
def incremental_high_water(t: Retail):
    loaded = t.bronze_orders.where(F.col("_ingested_at") == ntz(FIRST_LOAD_TS))
    return changes.new_rows(t.bronze_orders, loaded, "_ingested_at").select("order_id", "_ingested_at")


def placed_later() -> Column:
    return F.coalesce(F.to_date("order_date") > F.lit(KNOWN_UNTIL), F.lit(False))


def shipped_later() -> Column:
    shipped = F.date_add(F.to_date("order_date"), F.col("ship_days"))
    return F.coalesce(shipped > F.lit(KNOWN_UNTIL), F.lit(False)) & ~placed_later()


def known_orders(t: Retail) -> DataFrame:
    """The cleaned orders as they were at the end of ``KNOWN_UNTIL``."""
    bronze = t.bronze_orders.where(~placed_later())
    not_yet = F.when(~shipped_later(), F.col("ship_days"))
    return silver.silver_orders(bronze.withColumn("ship_days", not_yet), t.batch_ts)


KNOWN = f"""SELECT * REPLACE (CASE WHEN NOT ({SHIPPED}) THEN ship_days END AS ship_days)
    FROM silver_orders WHERE NOT {NEW}"""


def cdc_batch(t: Retail) -> DataFrame:
    """Order lines shipped since as updates, lines placed since as inserts; the feed is read once."""
    operation = F.when(placed_later(), "INSERT").otherwise("UPDATE")
    return cdc_tag(t.bronze_orders.where(placed_later() | shipped_later()), operation, ntz(CDC_TS))


@query(
    "cdc_batch_tagging",
    with_layers(
        f"""SELECT *, CASE WHEN {NEW} THEN 'INSERT' ELSE 'UPDATE' END AS _cdc_operation,
          {CDC_SQL_TS} AS _cdc_timestamp FROM bronze_orders WHERE ({SHIPPED}) OR {NEW}""",
        "bronze_orders",
    ),
)
def cdc_batch_tagging(t: Retail):
    return cdc_batch(t)


def conformed_batch(t: Retail) -> DataFrame:
    """The change batch brought to the target's columns and types before merging."""
    return silver.silver_orders(cdc_batch(t), ntz(CDC_TS))


CHANGED = f"SELECT * REPLACE ({CDC_SQL_TS} AS _updated_at) FROM silver_orders WHERE ({SHIPPED}) OR {NEW}"


@query("cdc_conform", with_layers(CHANGED, "silver_orders"))
def cdc_conform(t: Retail):
    return conformed_batch(t)


@query(
    "merge_upsert",
    with_layers(
        f"{CHANGED} UNION ALL SELECT * FROM silver_orders WHERE NOT (({SHIPPED}) OR {NEW})",
        "silver_orders",
    ),
)
def merge_upsert(t: Retail):
    return changes.upsert(
        known_orders(t), conformed_batch(t), ["order_id"], order=[F.desc("_ingested_at")]
    )


@query(
    "merge_partitions",
    with_layers(
        f"{CHANGED} UNION ALL SELECT * FROM silver_orders WHERE NOT (({SHIPPED}) OR {NEW})",
        "silver_orders",
    ),
)
def merge_partitions(t: Retail):
    """As ``merge_upsert``, into a table by month: earlier months than the batch's are not rewritten."""
    known = known_orders(t)
    path = scratch_path(t.spark, "orders_by_month")
    known.hint("rebalance", "order_month_key").write.partitionBy("order_month_key").parquet(path)
    merge.merge_partitions(
        t.spark, path, conformed_batch(t), ["order_id"], "order_month_key", [F.desc("_ingested_at")]
    )
    return merge.read_partitioned(t.spark, path, known)


def sold(t: Retail, orders: DataFrame) -> DataFrame:
    """What the daily report reads of the fact rows of some orders."""
    lines = star.with_product(star.order_lines(orders), t.dim_product, as_text(t.hot_products))
    return lines.select(*gold.DAILY_COLUMNS)


@query("gold_daily_sales_refreshed", layer("gold_daily_sales"))
def gold_daily_sales_refreshed(t: Retail):
    """The daily report of the known orders, brought up to date with the change batch only."""
    root = scratch_path(t.spark, "daily-state")
    known = materialize(sold(t, known_orders(t)), "known-fact")
    increments.build(known, gold.DAILY_STATE, root)
    batch = materialize(sold(t, conformed_batch(t)), "batch-fact")
    moved = increments.images(known, batch, ["order_id"])
    increments.refresh(t.spark, root, moved, gold.DAILY_STATE, "since-known")
    return gold.daily_sales_of(increments.read_totals(t.spark, root))


@query(
    "merge_update_columns",
    with_layers(f"SELECT * FROM silver_orders WHERE NOT {NEW}", "silver_orders"),
)
def merge_update_columns(t: Retail):
    source = t.bronze_orders.where(shipped_later()).select("order_id", "ship_days")
    return changes.update_columns(known_orders(t), source, ["order_id"], ["ship_days"])


CANCELLED = "status = 'Cancelled'"


@query(
    "soft_delete",
    with_layers(
        f"""SELECT * REPLACE (coalesce({CANCELLED}, FALSE) AS is_deleted,
          CASE WHEN {CANCELLED} THEN {CDC_SQL_TS} ELSE {BATCH_TS} END AS _updated_at) FROM silver_orders""",
        "silver_orders",
    ),
)
def soft_delete(t: Retail):
    """Orders cancelled by the customer are flagged, not removed."""
    doomed = t.bronze_orders.where(CANCELLED).select("order_id")
    return changes.soft_delete(t.silver_orders, doomed, ["order_id"], ntz(CDC_TS))


@query(
    "fact_orders_after_delete",
    with_layers(f"SELECT * FROM fact_orders WHERE {CANCELLED} IS NOT TRUE", "fact_orders"),
)
def fact_orders_after_delete(t: Retail):
    """A soft delete reaches the fact: flagged orders are no longer in it."""
    return star.fact_orders(
        soft_delete(t),
        t.dim_customer,
        t.dim_product,
        hot_customers=as_text(t.hot_customers),
        hot_products=as_text(t.hot_products),
        customer_ids=t.customer_ids,
    )


@query(
    "merge_delete_unmatched",
    with_layers(
        f"""SELECT * REPLACE ({CDC_SQL_TS} AS _updated_at) FROM silver_products
        WHERE _ingested_at = {LOADS[1]}""",
        "silver_products",
    ),
)
def merge_delete_unmatched(t: Retail):
    """The second load taken as the whole catalogue: products missing from it go."""
    second = t.bronze_products.where(F.col("_ingested_at") > ntz(FIRST_LOAD_TS))
    source = silver.silver_products(second, ntz(CDC_TS))
    return changes.upsert(t.silver_products, source, ["product_id"], delete_unmatched=True)


MOVED = "substr(md5('m' || customer_id), 1, 8) < '1999999a'"
UNKNOWN = "substr(md5('u' || customer_id), 1, 8) < '0ccccccc'"


def snapshot_rows(t: Retail) -> DataFrame:
    return snapshot(t.silver_customers)


def later_snapshot(t: Retail) -> DataFrame:
    """The next day's customers: some changed segment, some lost their city."""
    return snapshot_rows(t).withColumns(
        {
            "segment": F.when(F.expr(MOVED), "PREMIUM").otherwise(F.col("segment")),
            "city": F.when(~F.expr(UNKNOWN), F.col("city")),
            "_updated_at": ntz(CDC_TS),
        }
    )


SNAPSHOT_SQL = (
    "SELECT customer_id, full_name, email_masked AS email, age, age_band, city, state, segment, "
    "join_date, is_active, _updated_at FROM silver_customers"
)
LATER_SQL = f"""SELECT * REPLACE (CASE WHEN {MOVED} THEN 'PREMIUM' ELSE segment END AS segment,
    CASE WHEN NOT ({UNKNOWN}) THEN city END AS city, {CDC_SQL_TS} AS _updated_at) FROM snap"""


def _history_sql(first: str) -> str:
    version = "md5(concat_ws('|', {0}.customer_id, CAST({0}._updated_at AS VARCHAR))) AS scd_id"
    return with_layers(
        f"""SELECT o.*, {version.format("o")}, o._updated_at AS valid_from,
          CASE WHEN n.customer_id IS NOT NULL AND (o.segment IS DISTINCT FROM n.segment
            OR o.city IS DISTINCT FROM n.city OR o.state IS DISTINCT FROM n.state
            OR o.is_active IS DISTINCT FROM n.is_active) THEN n._updated_at END AS valid_to
        FROM day1 o LEFT JOIN day2 n ON o.customer_id = n.customer_id
        UNION ALL SELECT n.*, {version.format("n")}, n._updated_at, CAST(NULL AS TIMESTAMP)
        FROM day2 n LEFT JOIN day1 o ON o.customer_id = n.customer_id
        WHERE o.customer_id IS NULL OR o.segment IS DISTINCT FROM n.segment
          OR o.city IS DISTINCT FROM n.city OR o.state IS DISTINCT FROM n.state
          OR o.is_active IS DISTINCT FROM n.is_active""",
        "silver_customers",
    ).replace(
        "\nSELECT o.*",
        f",\nsnap AS ({SNAPSHOT_SQL}), day1 AS ({first}), day2 AS ({LATER_SQL})\nSELECT o.*",
        1,
    )


@query("scd2_snapshot", _history_sql(f"{SNAPSHOT_SQL} WHERE _ingested_at = {LOADS[0]}"))
def scd2_snapshot(t: Retail):
    """History of the first load, then everybody: changed, unchanged and new customers."""
    first = snapshot(t.silver_customers.where(F.col("_ingested_at") == ntz(FIRST_LOAD_TS)))
    history = changes.scd2(None, first, "customer_id", SNAPSHOT_CHECKS)
    return changes.scd2(history, later_snapshot(t), "customer_id", SNAPSHOT_CHECKS)


@query("scd_customers", _history_sql("SELECT * FROM snap"))
def scd_customers(t: Retail):
    history = changes.scd2(None, snapshot_rows(t), "customer_id", SNAPSHOT_CHECKS)
    return changes.scd2(history, later_snapshot(t), "customer_id", SNAPSHOT_CHECKS)


GONE = "substr(md5('g' || product_id), 1, 8) < '0ccccccc'"
PRICED = "substr(md5('p' || product_id), 1, 8) < '1999999a'"
EARLY = "substr(md5('e' || product_id), 1, 8) >= '0ccccccc'"


@query(
    "table_changes",
    with_layers(
        f"""WITH_ROWS SELECT *, 'delete' AS _change_type FROM silver_products WHERE {EARLY} AND {GONE}
        UNION ALL SELECT *, 'insert' FROM later WHERE NOT ({EARLY})
        UNION ALL SELECT *, 'update_pre' FROM silver_products WHERE {EARLY} AND NOT ({GONE}) AND {PRICED}
        UNION ALL SELECT *, 'update_post' FROM later WHERE {EARLY} AND {PRICED}""",
        "silver_products",
    ).replace(
        "\nWITH_ROWS",
        f""",\nlater AS (SELECT * REPLACE (CASE WHEN {PRICED} THEN retail_price + 1 ELSE retail_price END
          AS retail_price) FROM silver_products WHERE NOT ({GONE}))\n""",
    ),
)
def table_changes(t: Retail):
    """Every column counts as a change, not only the ones that happen to differ here."""
    products = t.silver_products
    old = products.where(EARLY)
    new = products.where(f"NOT ({GONE})").withColumn(
        "retail_price", F.when(F.expr(PRICED), F.col("retail_price") + 1).otherwise(F.col("retail_price"))
    )
    return changes.table_changes(old, new, ["product_id"])
