"""One query per relational building block: projections, filters, joins, aggregates, windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.catalog.change_queries import CANCELLED, soft_delete
from shopgrain.catalog.reference_sql import AS_OF, layer, mean, money, ratio, rnd, total, with_layers
from shopgrain.catalog.registry import query
from shopgrain.functions import money_sum, email_mask, ratio as safe_ratio, rounded, surrogate_key
from shopgrain.functions.columns import mean_money
from shopgrain.functions.labels import (
    age_band,
    discount_tier,
    rfm_segment,
    status_flags,
    stock_status,
)
from shopgrain.operators.changes import latest_per_key, sample_by_key
from shopgrain.operators.distinct import totals_with_counts
from shopgrain.operators.ranks import rank_distributed
from shopgrain.plans import gold, silver
from shopgrain.session import materialize, scratch_path
from shopgrain.sources.conform import FIRST_LOAD_TS, Retail, ntz
from shopgrain.streaming.ingest import read_evolving

# --- scans and simple sources ---------------------------------------------------------------


@query("table_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def table_scan(t: Retail):
    return t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("full_refresh_table", layer("gold_daily_sales"))
def full_refresh_table(t: Retail):
    path = scratch_path(t.spark, "daily_sales")
    sold = materialize(t.order_profit.select(*gold.DAILY_COLUMNS), "order-profit")
    gold.daily_sales(sold).write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query(
    "inline_rows",
    """SELECT label, COUNT(*) AS n_orders
    FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) AS v(code, label)
      ON o_orderstatus = code GROUP BY label""",
)
def inline_rows(t: Retail):
    labels = t.spark.createDataFrame(
        [("F", "finished"), ("O", "open"), ("P", "partial")], "code string, label string"
    )
    # Count per code first: the literal rows then meet three rows, however many orders there are.
    counts = t.table("orders").groupBy(F.col("o_orderstatus").alias("code")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return counts.join(labels, "code").select("label", "n_orders")


FEEDS = ("bronze_orders", "bronze_products", "bronze_customers", "bronze_inventory")


@query(
    "table_row_counts",
    with_layers(
        " UNION ALL ".join(
            f"SELECT '{f}' AS table_name, COUNT(*) AS row_count FROM {f}" for f in FEEDS
        ),
        *FEEDS,
    ),
)
def table_row_counts(t: Retail):
    counts = [
        getattr(t, f).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(f).alias("table_name"), "row_count"
        )
        for f in FEEDS
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "schema_evolving_append",
    with_layers(
        """SELECT product_id, category, retail_price,
          CASE WHEN CAST(product_id AS BIGINT) % 2 = 0 THEN NULL ELSE supplier_id END AS supplier_id
        FROM bronze_products""",
        "bronze_products",
    ),
)
def schema_evolving_append(t: Retail):
    columns = ["product_id", "category", "retail_price"]
    first = t.bronze_products.where(F.col("_ingested_at") == ntz(FIRST_LOAD_TS)).select(*columns)
    second = t.bronze_products.where(F.col("_ingested_at") > ntz(FIRST_LOAD_TS)).select(
        *columns, "supplier_id"
    )
    table = scratch_path(t.spark, "evolving")
    for batch in (first, second):
        batch.write.mode("append").parquet(table)
    return read_evolving(t.spark, table)


# --- projections and filters ----------------------------------------------------------------


@query(
    "project_rename",
    with_layers(
        "SELECT customer_id, full_name, email_masked AS email, city AS town FROM silver_customers",
        "silver_customers",
    ),
)
def project_rename(t: Retail):
    return t.silver_customers.select(
        "customer_id", "full_name", F.col("email_masked").alias("email"), F.col("city").alias("town")
    )


@query(
    "typed_projection",
    with_layers(
        """SELECT order_id, quantity, unit_price, discount_pct, gross_amount, net_amount,
          CAST(order_date AS DATE) AS order_date, ship_days FROM bronze_orders""",
        "bronze_orders",
    ),
)
def typed_projection(t: Retail):
    # The raw text form goes in, as it would come from a CSV file without a schema.
    text = t.bronze_orders.select(
        *[F.col(c).cast("string").alias(c) for c in t.bronze_orders.columns]
    )
    return silver.typed_orders(text).select(
        "order_id", "quantity", "unit_price", "discount_pct", "gross_amount", "net_amount",
        "order_date", "ship_days",
    )


@query(
    "select_star_extend",
    f"SELECT *, o_totalprice > 100000 AS is_large, {rnd('o_totalprice / 2', 2)} AS half_price FROM orders",
)
def select_star_extend(t: Retail):
    return t.table("orders").withColumns(
        {"is_large": F.col("o_totalprice") > 100000, "half_price": rounded(F.col("o_totalprice") / 2, 2)}
    )


@query(
    "filter_not_null_key",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IS NOT NULL",
)
def filter_not_null_key(t: Retail):
    return t.table("customer").where(F.col("c_custkey").isNotNull()).select("c_custkey", "c_name")


@query(
    "filter_positive_measures",
    with_layers(
        "SELECT order_id, quantity, net_amount FROM bronze_orders WHERE quantity > 0 AND net_amount > 0",
        "bronze_orders",
    ),
)
def filter_positive_measures(t: Retail):
    return t.bronze_orders.where("quantity > 0 AND net_amount > 0").select(
        "order_id", "quantity", "net_amount"
    )


@query(
    "filter_soft_deleted",
    with_layers(f"SELECT order_id FROM silver_orders WHERE {CANCELLED} IS NOT TRUE", "silver_orders"),
)
def filter_soft_deleted(t: Retail):
    return soft_delete(t).where(~F.col("is_deleted")).select("order_id")


@query("filter_equality", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_equality(t: Retail):
    return t.table("events").where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "value"
    )


@query(
    "predicate_between",
    with_layers(
        "SELECT customer_id, age, age BETWEEN 18 AND 50 AS is_target FROM bronze_customers "
        "WHERE age BETWEEN 18 AND 100",
        "bronze_customers",
    ),
)
def predicate_between(t: Retail):
    return t.bronze_customers.where(F.col("age").between(18, 100)).select(
        "customer_id", "age", F.col("age").between(18, 50).alias("is_target")
    )


@query(
    "predicate_like",
    with_layers(
        "SELECT customer_id, email LIKE '%@%.%' AS valid_email, email LIKE '%.%7@%' AS ends_with_7 "
        "FROM bronze_customers",
        "bronze_customers",
    ),
)
def predicate_like(t: Retail):
    return t.bronze_customers.select(
        "customer_id",
        F.col("email").like("%@%.%").alias("valid_email"),
        F.col("email").like("%.%7@%").alias("ends_with_7"),
    )


@query(
    "predicate_in_list",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE month(o_orderdate) IN (11, 12) "
    "AND dayofweek(o_orderdate) + 1 IN (1, 7)",
)
def predicate_in_list(t: Retail):
    return (
        t.table("orders")
        .where(F.month("o_orderdate").isin(11, 12) & F.dayofweek("o_orderdate").isin(1, 7))
        .select("o_orderkey", "o_orderdate")
    )


@query(
    "case_discount_tier",
    with_layers(
        "SELECT discount_tier, COUNT(*) AS n, MIN(discount_pct) AS lowest, MAX(discount_pct) AS highest "
        "FROM silver_orders GROUP BY 1",
        "silver_orders",
    ),
)
def case_discount_tier(t: Retail):
    return (
        t.silver_orders.drop("discount_tier")
        .withColumn("discount_tier", discount_tier("discount_pct"))
        .groupBy("discount_tier")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("discount_pct").alias("lowest"),
            F.max("discount_pct").alias("highest"),
        )
    )


@query(
    "case_age_band",
    with_layers("SELECT customer_id, age, age_band FROM silver_customers", "silver_customers"),
)
def case_age_band(t: Retail):
    return t.bronze_customers.select("customer_id", "age", age_band("age").alias("age_band"))


@query(
    "case_status_flags",
    with_layers(
        "SELECT order_id, is_returned, is_cancelled, is_completed FROM fact_orders", "fact_orders"
    ),
)
def case_status_flags(t: Retail):
    return t.silver_orders.select(
        "order_id", *[c.alias(name) for name, c in status_flags().items()]
    )


@query(
    "case_stock_status",
    with_layers(
        """SELECT inventory_id, CASE WHEN is_out_of_stock THEN 'Out of Stock'
          WHEN is_below_reorder THEN 'Low Stock' ELSE 'Healthy' END AS stock_status
        FROM silver_inventory""",
        "silver_inventory",
    ),
)
def case_stock_status(t: Retail):
    return t.silver_inventory.select(
        "inventory_id", stock_status("is_out_of_stock", "is_below_reorder").alias("stock_status")
    )


@query(
    "case_rfm_segment",
    with_layers(
        "SELECT rfm_segment, COUNT(*) AS customers FROM gold_customer_rfm GROUP BY 1",
        "gold_customer_rfm",
    ),
)
def case_rfm_segment(t: Retail):
    base = materialize(gold.rfm_base(t.order_lines, t.as_of), "rfm_base")
    return (
        gold.rfm_scores(base)
        .select(rfm_segment("r_score", "f_score", "m_score").alias("rfm_segment"))
        .groupBy("rfm_segment")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


@query("drop_column", "SELECT * EXCLUDE (props) FROM events")
def drop_column(t: Retail):
    return t.table("events").drop("props")


@query(
    "literal_columns",
    "SELECT c_custkey, FALSE AS is_deleted, 'UPDATE' AS operation, 1 AS version FROM customer",
)
def literal_columns(t: Retail):
    return t.table("customer").select(
        "c_custkey",
        F.lit(False).alias("is_deleted"),
        F.lit("UPDATE").alias("operation"),
        F.lit(1).alias("version"),
    )


@query(
    "sample_rows",
    "SELECT o_orderkey, o_custkey FROM orders "
    "WHERE substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) < '028f5c28'",
)
def sample_rows(t: Retail):
    return sample_by_key(t.table("orders"), "o_orderkey", 0.01).select("o_orderkey", "o_custkey")


@query("sample_rows_seeded")
def sample_rows_seeded(t: Retail):
    return t.table("orders").sample(fraction=0.01, seed=42)


@query(
    "head_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def head_rows(t: Retail):
    return (
        t.table("orders")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(5)
        .select("o_orderkey", "o_totalprice")
    )


# --- joins ----------------------------------------------------------------------------------


@query(
    "join_left_star",
    with_layers(
        "SELECT order_id, customer_key, product_key, gross_profit FROM fact_orders", "fact_orders"
    ),
)
def join_left_star(t: Retail):
    return t.fact_orders.select("order_id", "customer_key", "product_key", "gross_profit")


@query(
    "join_inner_dim",
    with_layers(
        f"""SELECT p.category, COUNT(*) AS n_orders, {total("o.net_amount")} AS revenue
        FROM silver_orders o JOIN dim_product p ON o.product_id = p.product_id GROUP BY 1""",
        "silver_orders",
        "dim_product",
    ),
)
def join_inner_dim(t: Retail):
    # Totals per product first, so the join meets one row per product and no product is hot.
    per_product = t.silver_orders.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), money_sum("net_amount").alias("net")
    )
    return (
        per_product.join(t.dim_product.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("n").alias("n_orders"), F.round(F.sum("net"), 2).cast("double").alias("revenue"))
    )


@query(
    "join_anti",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN "
    "(SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def join_anti(t: Retail):
    partial = t.table("orders").where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey")
    )
    return t.table("customer").select("c_custkey").join(partial.distinct(), "c_custkey", "left_anti")


@query(
    "join_semi",
    "SELECT c_custkey FROM customer WHERE c_custkey IN "
    "(SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def join_semi(t: Retail):
    partial = t.table("orders").where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey")
    )
    return t.table("customer").select("c_custkey").join(partial.distinct(), "c_custkey", "left_semi")


@query(
    "scalar_subquery_max",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > "
    "(SELECT MAX(o_orderdate) FROM orders WHERE o_orderstatus = 'F') - INTERVAL 30 DAY",
)
def scalar_subquery_max(t: Retail):
    orders = t.table("orders")
    last = orders.where("o_orderstatus = 'F'").select(F.max("o_orderdate"))
    return orders.where(F.col("o_orderdate") > last.scalar() - F.expr("INTERVAL 30 DAY")).select(
        "o_orderkey", "o_orderdate"
    )


# --- aggregates -----------------------------------------------------------------------------


@query(
    "agg_multi_distinct",
    """SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_partkey) AS parts,
      COUNT(DISTINCT l_suppkey) AS suppliers, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
    FROM lineitem GROUP BY 1""",
)
def agg_multi_distinct(t: Retail):
    units = F.sum(F.col("l_quantity").cast("bigint")).alias("units")
    counts = {"orders": "l_orderkey", "parts": "l_partkey", "suppliers": "l_suppkey"}
    return totals_with_counts(t.table("lineitem"), ["l_returnflag"], [units], counts, numbers=True)


@query(
    "agg_sum_round",
    f"SELECT o_orderpriority, {total('o_totalprice')} AS total_price FROM orders GROUP BY 1",
)
def agg_sum_round(t: Retail):
    return t.table("orders").groupBy("o_orderpriority").agg(
        F.round(money_sum("o_totalprice"), 2).cast("double").alias("total_price")
    )


@query(
    "agg_avg_round",
    f"SELECT l_returnflag, {rnd(mean('l_extendedprice'), 2)} AS avg_price, "
    f"{rnd(mean('l_discount') + ' * 100', 2)} AS avg_discount_pct FROM lineitem GROUP BY 1",
)
def agg_avg_round(t: Retail):
    return t.table("lineitem").groupBy("l_returnflag").agg(
        rounded(mean_money("l_extendedprice"), 2).alias("avg_price"),
        rounded(mean_money("l_discount") * 100, 2).alias("avg_discount_pct"),
    )


@query(
    "agg_conditional_sum",
    with_layers(
        """SELECT channel, CAST(SUM(CASE WHEN status = 'Returned' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
          CAST(SUM(CASE WHEN status = 'Cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled,
          COUNT(*) FILTER (WHERE status = 'Completed') AS completed FROM silver_orders GROUP BY 1""",
        "silver_orders",
    ),
)
def agg_conditional_sum(t: Retail):
    return t.order_lines.groupBy("channel").agg(
        F.sum("is_returned").alias("returned"),
        F.sum("is_cancelled").alias("cancelled"),
        F.count_if(F.col("status") == "Completed").alias("completed"),
    )


@query(
    "agg_safe_ratio_pct",
    with_layers(
        f"""SELECT region, {rnd(ratio("SUM(is_returned) * 100", "COUNT(*)"), 2)} AS return_rate_pct,
          {rnd(ratio("SUM(is_returned) * 100", "SUM(is_cancelled)"), 2)} AS returned_per_cancelled
        FROM fact_orders GROUP BY 1""",
        "fact_orders",
    ),
)
def agg_safe_ratio_pct(t: Retail):
    returned = F.sum("is_returned") * 100
    return t.order_lines.groupBy("region").agg(
        rounded(safe_ratio(returned, F.count(F.lit(1))), 2).alias("return_rate_pct"),
        rounded(safe_ratio(returned, F.sum("is_cancelled")), 2).alias("returned_per_cancelled"),
    )


@query(
    "agg_max_recency",
    f"""SELECT o_custkey, CAST(MAX(o_orderdate) AS DATE) AS last_order_date,
      CAST(date_diff('day', CAST(MAX(o_orderdate) AS DATE), {AS_OF}) AS INTEGER) AS recency_days
    FROM orders GROUP BY 1""",
)
def agg_max_recency(t: Retail):
    return t.table("orders").groupBy("o_custkey").agg(
        F.to_date(F.max("o_orderdate")).alias("last_order_date"),
        F.datediff(t.as_of, F.max("o_orderdate")).alias("recency_days"),
    )


@query(
    "group_by_ordinals",
    f"SELECT l_returnflag, l_linestatus, COUNT(*) AS n, {total('l_extendedprice')} AS price "
    "FROM lineitem GROUP BY 1, 2",
)
def group_by_ordinals(t: Retail):
    return t.spark.sql(
        "SELECT l_returnflag, l_linestatus, count(*) AS n, "
        "CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,4))), 2) AS DOUBLE) AS price "
        "FROM {lines} GROUP BY 1, 2",
        lines=t.table("lineitem"),
    )


@query("agg_count_star", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def agg_count_star(t: Retail):
    return t.table("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# --- windows, sorting, sets -----------------------------------------------------------------


@query(
    "window_ntile",
    with_layers("SELECT customer_id, r_score, f_score, m_score FROM rfm_scores", "rfm_scores"),
)
def window_ntile(t: Retail):
    base = materialize(gold.rfm_base(t.order_lines, t.as_of), "rfm_base")
    return gold.rfm_scores(base).select("customer_id", "r_score", "f_score", "m_score")


@query(
    "window_latest_row",
    with_layers(
        "SELECT product_id, warehouse_id, snapshot_date, quantity_on_hand FROM current_stock",
        "current_stock",
    ),
)
def window_latest_row(t: Retail):
    return gold.current_stock(t.silver_inventory).select(
        "product_id", "warehouse_id", "snapshot_date", "quantity_on_hand"
    )


@query(
    "window_rank_over_agg",
    f"""SELECT c_nationkey, c_custkey, CAST(RANK() OVER (PARTITION BY c_nationkey
      ORDER BY SUM({money("o_totalprice")}) DESC) AS BIGINT) AS spend_rank
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def window_rank_over_agg(t: Retail):
    spend = t.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        money_sum("o_totalprice").alias("spend")
    )
    per_customer = spend.join(t.table("customer").select("c_custkey", "c_nationkey"), "c_custkey")
    ranked = rank_distributed(
        materialize(per_customer, "spend"), ["c_nationkey"], -F.col("spend"), "spend_rank"
    )
    return ranked.drop("spend")


@query(
    "sort_by_date",
    with_layers(
        "SELECT ds, y FROM daily_total ORDER BY ds",
        "daily_total",
    ),
)
def sort_by_date(t: Retail):
    sales = gold.daily_revenue(t.order_profit)
    return (
        sales.groupBy(F.col("order_date").alias("ds"))
        .agg(money_sum("total_revenue").cast("double").alias("y"))
        .orderBy("ds")
    )


@query(
    "union_all_positional",
    "SELECT c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL "
    "SELECT s_suppkey, s_acctbal FROM supplier",
)
def union_all_positional(t: Retail):
    customers = t.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")
    )
    return customers.union(t.table("supplier").select("s_suppkey", "s_acctbal"))


@query(
    "dedup_by_key",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def dedup_by_key(t: Retail):
    return latest_per_key(
        t.table("orders").select("o_custkey", "o_orderkey", "o_orderdate"),
        ["o_custkey"],
        [F.desc("o_orderdate"), F.desc("o_orderkey")],
    )


# --- scalar functions -----------------------------------------------------------------------


@query(
    "scalar_date_functions",
    f"""SELECT o_orderkey, CAST(d AS DATE) AS day, CAST(year(d) AS INTEGER) AS y,
      CAST(quarter(d) AS INTEGER) AS q, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dom,
      CAST(dayofweek(d) + 1 AS INTEGER) AS dow, strftime(d, '%Y-%m') AS ym, strftime(d, '%B') AS month_name,
      strftime(d, '%A') AS day_name,
      CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS yq,
      CAST(date_diff('day', d, {AS_OF}) AS INTEGER) AS days_ago, CAST(d - 30 AS DATE) AS month_before,
      CAST(d + INTERVAL 1 MONTH AS DATE) AS next_month, CAST(date_trunc('month', d) AS DATE) AS month_start
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def scalar_date_functions(t: Retail):
    d = F.col("day")
    days = t.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return days.select(
        "o_orderkey",
        "day",
        F.year(d).alias("y"),
        F.quarter(d).alias("q"),
        F.month(d).alias("m"),
        F.dayofmonth(d).alias("dom"),
        F.dayofweek(d).alias("dow"),
        F.date_format(d, "yyyy-MM").alias("ym"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "yyyy-'Q'Q").alias("yq"),
        F.datediff(t.as_of, d).alias("days_ago"),
        F.date_sub(d, 30).alias("month_before"),
        F.add_months(d, 1).alias("next_month"),
        F.to_date(F.date_trunc("month", d)).alias("month_start"),
    )


@query(
    "scalar_math_functions",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
      {rnd("l_extendedprice * (1 - l_discount)", 2)} AS net,
      CAST(l_orderkey % 7 AS BIGINT) AS bucket, {rnd("abs(l_quantity - 25)", 4)} AS distance,
      {rnd("sqrt(l_quantity)", 6)} AS root, {rnd(ratio("l_extendedprice", "l_tax"), 4)} AS per_tax
    FROM lineitem""",
)
def scalar_math_functions(t: Retail):
    return t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        rounded(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net"),
        (F.col("l_orderkey") % 7).alias("bucket"),
        rounded(F.abs(F.col("l_quantity") - 25), 4).alias("distance"),
        rounded(F.sqrt("l_quantity"), 6).alias("root"),
        rounded(safe_ratio("l_extendedprice", "l_tax"), 4).alias("per_tax"),
    )


@query(
    "scalar_string_functions",
    """SELECT c_custkey, c_name || '/' || c_mktsegment AS joined,
      concat_ws(' ', c_name, NULL, c_mktsegment) AS joined_skip,
      CAST(c_custkey AS VARCHAR) || CAST(c_nationkey AS VARCHAR) AS digits,
      md5(COALESCE(CAST(c_custkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' || c_mktsegment)
        AS row_key,
      c_mktsegment LIKE '%E%' AS has_e, [c_name, c_mktsegment][1 + (c_acctbal < 0)::INT] AS picked
    FROM customer""",
)
def scalar_string_functions(t: Retail):
    columns = F.array("c_name", "c_mktsegment")
    return t.table("customer").select(
        "c_custkey",
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
        F.concat_ws(" ", "c_name", F.lit(None).cast("string"), "c_mktsegment").alias("joined_skip"),
        F.concat(F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")).alias("digits"),
        surrogate_key("c_custkey", "c_mktsegment").alias("row_key"),
        F.col("c_mktsegment").like("%E%").alias("has_e"),
        F.element_at(columns, 1 + (F.col("c_acctbal") < 0).cast("int")).alias("picked"),
    )


@query(
    "mask_email",
    with_layers("SELECT customer_id, email_masked FROM silver_customers", "silver_customers"),
)
def mask_email(t: Retail):
    return t.bronze_customers.select("customer_id", email_mask("email").alias("email_masked"))


@query(
    "surrogate_keys",
    f"""SELECT l_returnflag, COUNT(DISTINCT md5(CAST(l_partkey AS VARCHAR) || '-' ||
      CAST(l_suppkey AS VARCHAR))) AS keys FROM lineitem GROUP BY 1""",
)
def surrogate_keys(t: Retail):
    return t.table("lineitem").groupBy("l_returnflag").agg(
        F.count_distinct(surrogate_key("l_partkey", "l_suppkey")).alias("keys")
    )
