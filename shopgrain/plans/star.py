"""Star schema: dimensions keyed by hashed business keys, and the order fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import as_money, ratio, rounded, surrogate_key
from shopgrain.functions.calendar import date_parts
from shopgrain.functions.labels import status_flags
from shopgrain.operators.changes import hashed_alike
from shopgrain.operators.joins import lookup_join
from shopgrain.plans.silver import order_attributes
from shopgrain.session import materialize

FACT_COLUMNS = [
    "order_key", "order_id", "order_date", "customer_key", "product_key", "customer_id",
    "product_id", "quantity", "unit_price", "discount_pct", "gross_amount", "net_amount",
    "avg_unit_net_price", "discount_tier", "channel", "region", "status", "ship_days",
    "order_year", "order_month", "order_month_key", "day_of_week", "gross_profit",
    "gross_margin_pct", "is_returned", "is_cancelled", "is_completed", "_updated_at",
]

#: Marks ids that a lookup did not find.
MISSING = "__missing"
#: Smaller dimensions are left to Spark, which broadcasts them.
MIN_LOOKED_UP = 100_000
#: So many ids that a dimension lacks are broadcast at most.
MOST_MISSING = 100_000

#: What the lookups move of an order; the other columns of the fact follow from these and are added last.
CARRIED = [
    "order_id", "order_date", "customer_id", "product_id", "quantity", "unit_price", "discount_pct", "gross_amount",
    "net_amount", "channel", "region", "status", "ship_days", "_updated_at",
]


def dim_customer(silver: DataFrame) -> DataFrame:
    return silver.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "full_name",
        F.col("email_masked").alias("email"),
        "age",
        "age_band",
        "city",
        "state",
        "segment",
        "join_date",
        "days_since_join",
        "is_active",
        "_updated_at",
    )


def dim_product(silver: DataFrame) -> DataFrame:
    return silver.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "cost_price",
        "retail_price",
        "margin_pct",
        "supplier_id",
        "is_active",
        "_updated_at",
    )


def date_spine(bounds: DataFrame, start: Column | str, end_exclusive: Column | str) -> DataFrame:
    """One row per day in [start, end) for the bounds found in a one-row frame."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end_exclusive) if isinstance(end_exclusive, str) else end_exclusive
    days = F.when(start < end, F.sequence(start, F.date_sub(end, 1)))
    return bounds.select(F.explode(days).alias("date_day"))


def dim_date(spine: DataFrame) -> DataFrame:
    parts = date_parts("date_day")
    return spine.select(
        F.col("date_day").alias("date_key"),
        F.col("date_day").alias("full_date"),
        *[c.alias(name) for name, c in parts.items()],
    )


def line_attributes() -> dict[str, Column]:
    return {"order_key": surrogate_key("order_id"), **status_flags()}


def order_lines(silver_orders: DataFrame) -> DataFrame:
    """Visible orders with their key and status flags; no lookups yet."""
    return silver_orders.where(~F.col("is_deleted")).withColumns(line_attributes())


def _with_cost(lines: DataFrame, products: DataFrame, hot: list | None) -> DataFrame:
    costs = products.select("product_id", "product_key", F.col("cost_price").alias("__cost"))
    return lookup_join(lines, costs, "product_id", "left", hot)


def keys_follow(lines: DataFrame, dim: DataFrame, id_col: str, key: str) -> bool:
    """Whether every key of a dimension is the surrogate key of its id, so that a row knows the key when it knows that
    its id is there. For a dimension that isn't written yet the plan alone tells."""
    if lines.schema[id_col].dataType != dim.schema[id_col].dataType or not hashed_alike(dim, [id_col]):
        return False
    return dim.where(~F.col(key).eqNullSafe(surrogate_key(id_col))).isEmpty()


def _with_customer(
    lines: DataFrame, customers: DataFrame, hot: list | None, ids: DataFrame
) -> tuple[DataFrame, Column]:
    """The lines with what tells their customer key, and that key.

    A large dimension of unique ids that the keys follow from is asked for the ids it lacks: ids are moved then, not lines.
    ``ids`` has all customer ids of the lines at least.
    """
    keys = customers.select("customer_id", "customer_key")
    plain = lambda: (lookup_join(lines, keys, "customer_id", "left", hot), F.col("customer_key"))
    if keys.count() < MIN_LOOKED_UP or not keys_follow(lines, keys, "customer_id", "customer_key"):
        return plain()
    known = keys.where("customer_id IS NOT NULL").groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    if not known.where("n > 1").isEmpty():
        return plain()
    asked = ids.select("customer_id").where("customer_id IS NOT NULL").distinct()
    missing = materialize(asked.join(keys, "customer_id", "left_anti"), "missing-customers")
    count = missing.count()
    if count > MOST_MISSING:
        return plain()
    is_known = F.col("customer_id").isNotNull()
    if count:
        lines = lines.join(F.broadcast(missing.withColumn(MISSING, F.lit(True))), "customer_id", "left")
        is_known &= F.col(MISSING).isNull()
    return lines, F.when(is_known, surrogate_key("customer_id"))


def _with_profit(lines: DataFrame) -> DataFrame:
    profit = as_money("net_amount") - F.col("quantity") * as_money("__cost")
    return lines.withColumns(
        {
            "gross_profit": rounded(profit, 2),
            "gross_margin_pct": rounded(ratio(profit, as_money("net_amount")), 4),
        }
    ).drop("__cost")


def with_product(lines: DataFrame, products: DataFrame, hot: list | None = None) -> DataFrame:
    """Add product key and profit; both stay null for a product the dimension lacks."""
    return _with_profit(_with_cost(lines, products, hot))


def fact_orders(
    silver_orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    hot_customers: list | None = None,
    hot_products: list | None = None,
    rebalance_by: str | None = None,
    customer_ids: DataFrame | None = None,
) -> DataFrame:
    """The visible orders with both keys and the profit. Only CARRIED columns and what is looked up are shuffled:
    by the lookups, and, with ``rebalance_by`` (one of the order attributes), into even shares for a partitioned write.
    Keys that follow from the ids are added after that. ``customer_ids`` names the customers, if that is cheaper
    to read than the orders; it may hold more than theirs."""
    lines = silver_orders.where(~F.col("is_deleted")).select(*CARRIED)
    product_key = F.col("product_key")
    dim = products.select("product_id", "product_key", "cost_price")
    if keys_follow(lines, dim, "product_id", "product_key"):
        # The mark takes the place of the key on the way.
        dim = dim.withColumn("product_key", F.lit(True))
        product_key = F.when(product_key, surrogate_key("product_id"))
    found = _with_cost(lines, dim, hot_products)
    ids = silver_orders if customer_ids is None else customer_ids
    found, customer_key = _with_customer(found, customers, hot_customers, ids)
    attributes = order_attributes()
    if rebalance_by:
        found = found.withColumn(rebalance_by, attributes[rebalance_by]).hint("rebalance", rebalance_by)
    keys = {"product_key": product_key, "customer_key": customer_key}
    return _with_profit(found).withColumns({**line_attributes(), **attributes, **keys}).select(*FACT_COLUMNS)
