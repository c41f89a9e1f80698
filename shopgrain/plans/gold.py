"""Business aggregates over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import as_money, money_sum, ratio, rounded
from shopgrain.functions.columns import money_count
from shopgrain.functions.labels import rfm_segment, stock_status
from shopgrain.operators import increments
from shopgrain.operators.changes import latest_per_key
from shopgrain.operators.distinct import totals_with_counts
from shopgrain.operators.joins import lookup_join
from shopgrain.operators.ranks import ROWS_PER_BUCKET, ntile_distributed, rank_distributed
from shopgrain.session import materialize

DAILY_KEYS = ["order_date", "region", "channel"]
#: What the daily report reads of the fact.
DAILY_COLUMNS = [
    *DAILY_KEYS, "order_id", "customer_id", "product_id", "quantity", "gross_amount", "net_amount", "gross_profit",
    "gross_margin_pct", "is_returned", "is_cancelled",
]
PRODUCT_KEYS = ["product_id", "product_name", "category", "subcategory", "supplier_id"]


def _orders(unique: bool) -> Column:
    """Order count; one row per order makes the costly distinct count unnecessary."""
    return F.count("order_id") if unique else F.count_distinct("order_id")


def _sums() -> list[Column]:
    """The sums and counts all sales measures derive from, each carried through the shuffle once."""
    return [
        F.count(F.lit(1)).alias("__rows"),
        F.sum("quantity").alias("total_units_sold"),
        money_sum("net_amount").alias("__net"),
        money_count("net_amount").alias("__nets"),
        money_sum("gross_profit").alias("__profit"),
        money_sum("gross_margin_pct").alias("__margin"),
        money_count("gross_margin_pct").alias("__margins"),
        F.sum("is_returned").alias("__returned"),
    ]


def _money_total(total: Column | str) -> Column:
    return F.round(total, 2).cast("double")


def _measures() -> dict[str, Column]:
    return {
        "total_revenue": _money_total("__net"),
        "total_gross_profit": _money_total("__profit"),
        "avg_margin_pct": rounded(ratio("__margin", "__margins") * 100, 2),
        "avg_order_value": rounded(ratio("__net", "__nets"), 2),
        "return_rate_pct": rounded(ratio(F.col("__returned") * 100, "__rows"), 2),
    }


def daily_sales(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Sales per (day, region, channel). The calendar keys follow from the day and are added last.

    ``fact`` is read once for the sums and once per distinct count: pass a written table.
    """
    sums = [
        *_sums(),
        money_sum("gross_amount").alias("__gross"),
        F.sum("is_cancelled").alias("cancelled_orders"),
    ]
    counts = {"unique_customers": "customer_id", "unique_products": "product_id"}
    if orders_unique:
        sums.append(_orders(True).alias("total_orders"))
    else:
        counts["total_orders"] = "order_id"
    return _daily_report(totals_with_counts(fact, DAILY_KEYS, sums, counts))


def _daily_report(totals: DataFrame) -> DataFrame:
    measures = _measures()
    return totals.select(
        "order_date",
        "region",
        "channel",
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
        F.date_format("order_date", "yyyy-MM").alias("order_month_key"),
        "total_orders",
        "unique_customers",
        "unique_products",
        "total_units_sold",
        _money_total("__gross").alias("total_gross_revenue"),
        *[measures[m].alias(m) for m in list(measures)[:4]],
        F.col("__returned").alias("returned_orders"),
        "cancelled_orders",
        measures["return_rate_pct"].alias("return_rate_pct"),
    )


#: What is kept of the fact so that the daily report can follow its changes. One row per order.
DAILY_STATE = increments.Summary(
    keys=DAILY_KEYS,
    partition="date_format(order_date, 'yyyy-MM')",
    money=["net_amount", "gross_profit", "gross_margin_pct", "gross_amount"],
    integers=["quantity", "is_returned", "is_cancelled"],
    present=["order_id"],
    distinct=["customer_id", "product_id"],
)


def daily_sales_of(totals: DataFrame) -> DataFrame:
    """The daily report from kept totals, all or those of changed groups."""
    kept = totals.where(F.col(increments.ROWS) > 0)
    return _daily_report(
        kept.select(
            *DAILY_KEYS,
            F.col(increments.ROWS).alias("__rows"),
            F.col("order_id__n").alias("total_orders"),
            F.col("customer_id__distinct").alias("unique_customers"),
            F.col("product_id__distinct").alias("unique_products"),
            increments.integer("quantity").alias("total_units_sold"),
            increments.integer("is_returned").alias("__returned"),
            increments.integer("is_cancelled").alias("cancelled_orders"),
            increments.money("gross_amount").alias("__gross"),
            increments.money("net_amount").alias("__net"),
            increments.money("gross_profit").alias("__profit"),
            increments.money("gross_margin_pct").alias("__margin"),
            F.col("net_amount__n").alias("__nets"),
            F.col("gross_margin_pct__n").alias("__margins"),
        )
    )


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Revenue per (day, region, channel) as in ``daily_sales``, without its other measures."""
    return orders.groupBy("order_date", "region", "channel").agg(
        _money_total(money_sum("net_amount")).alias("total_revenue")
    )


def product_totals(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    """One row per product id, before any product attribute is looked up."""
    return fact.groupBy("product_id").agg(*_sums(), _orders(orders_unique).alias("total_orders"))


def product_performance(
    fact: DataFrame,
    products: DataFrame,
    orders_unique: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Sales per product, ranked by revenue within its category."""
    totals = product_totals(fact, orders_unique).join(products.select(*PRODUCT_KEYS), "product_id")
    ranked = rank_distributed(
        materialize(totals, "product_totals"),
        ["category"],
        -F.col("__net"),
        "revenue_rank_in_category",
        rows_per_bucket,
    )
    measures = _measures()
    return ranked.select(
        *PRODUCT_KEYS,
        "total_orders",
        "total_units_sold",
        *[measures[m].alias(m) for m in list(measures)[:4]],
        F.col("__returned").alias("total_returns"),
        measures["return_rate_pct"].alias("return_rate_pct"),
        F.col("revenue_rank_in_category").cast("int").alias("revenue_rank_in_category"),
    )


def rfm_base(fact: DataFrame, as_of: Column, orders_unique: bool = False) -> DataFrame:
    """Last order, order count and revenue of each customer's completed orders."""
    return (
        fact.where("is_completed = 1")
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order_date"),
            _orders(orders_unique).alias("frequency"),
            F.round(money_sum("net_amount"), 2).alias("monetary"),
        )
        .withColumn("recency_days", F.datediff(as_of, "last_order_date"))
    )


def rfm_scores(base: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Quintiles, 5 the best: most recent, most frequent, highest revenue."""
    return ntile_distributed(
        base,
        5,
        {
            "r_score": -F.col("recency_days"),
            "f_score": F.col("frequency"),
            "m_score": F.col("monetary"),
        },
        tie="customer_id",
        rows_per_bucket=rows_per_bucket,
    )


def customer_rfm(
    fact: DataFrame,
    customers: DataFrame,
    as_of: Column,
    orders_unique: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    base = materialize(rfm_base(fact, as_of, orders_unique), "rfm_base")
    scored = rfm_scores(base, rows_per_bucket).withColumns(
        {
            "monetary": F.col("monetary").cast("double"),
            "rfm_score": F.concat(
                *[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]
            ),
            "rfm_total": F.col("r_score") + F.col("f_score") + F.col("m_score"),
            "rfm_segment": rfm_segment("r_score", "f_score", "m_score"),
        }
    )
    attributes = customers.select("customer_id", "full_name", "segment", "city", "state", "age_band")
    return scored.join(attributes, "customer_id")


def current_stock(inventory: DataFrame) -> DataFrame:
    """The latest snapshot per (product, warehouse); same-day ties go to the highest id, then stock."""
    return latest_per_key(
        inventory,
        ["product_id", "warehouse_id"],
        [F.desc_nulls_last(c) for c in ("snapshot_date", "inventory_id", "quantity_on_hand")],
    )


def inventory_health(
    inventory: DataFrame, products: DataFrame, hot_products: list | None = None
) -> DataFrame:
    costs = products.select("product_id", "product_name", "category", "supplier_id", "cost_price")
    stock = lookup_join(current_stock(inventory), costs, "product_id", "inner", hot_products)
    value = F.col("quantity_on_hand") * as_money("cost_price")
    return stock.select(
        "product_id",
        "warehouse_id",
        F.col("snapshot_date").alias("latest_snapshot_date"),
        "quantity_on_hand",
        "reorder_level",
        "is_below_reorder",
        "is_out_of_stock",
        "product_name",
        "category",
        "supplier_id",
        stock_status("is_out_of_stock", "is_below_reorder").alias("stock_status"),
        rounded(value, 2).alias("inventory_value"),
    )


def masked_customers(silver: DataFrame) -> DataFrame:
    """Customers without raw names or addresses."""
    return silver.drop("first_name", "last_name", "full_name", "email").withColumnRenamed(
        "email_masked", "email"
    )
