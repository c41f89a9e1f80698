"""Express the generic order/line/part tables as the raw retail feeds.

Every function is lazy. ``hot`` arguments are short lists of join keys that hold an outsized
share of the rows (see ``operators.joins``).
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.operators.joins import hot_keys, lookup_join
from shopgrain.plans import silver, star

AS_OF = dt.date(2001, 8, 2)
BATCH_TS = "2001-08-02 12:00:00"
FIRST_LOAD_TS = "2001-08-02 00:00:00"
SECOND_LOAD_TS = "2001-08-02 06:00:00"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _load_ts(key: str) -> Column:
    """Two load batches, split by key parity, so incremental reads have something to skip."""
    return F.when(F.col(key) % 2 == 0, ntz(FIRST_LOAD_TS)).otherwise(ntz(SECOND_LOAD_TS))


def _day_text(c: str) -> Column:
    return F.date_format(F.to_date(c), "yyyy-MM-dd")


def _line_id() -> Column:
    return F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        _day_text("l_shipdate"),
    )


def as_text(keys: list) -> list[str | None]:
    """Hot keys of a number column for its text form; null stays null."""
    return [None if k is None else str(k) for k in keys]


class Retail:
    """Raw feeds, cleaned layers and star schema over one folder of source tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.batch_ts = ntz(BATCH_TS)
        self.as_of = F.lit(AS_OF)
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def lines(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def hot_orders(self) -> list:
        return hot_keys(self.table("lineitem"), "l_orderkey")

    @cached_property
    def hot_customers(self) -> list:
        return hot_keys(self.table("orders"), "o_custkey")

    @cached_property
    def hot_products(self) -> list:
        return hot_keys(self.table("lineitem"), "l_partkey")

    @cached_property
    def _customer_places(self) -> DataFrame:
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        return self.table("customer").join(
            nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )

    @cached_property
    def bronze_orders(self) -> DataFrame:
        customers = self._customer_places.select(F.col("c_custkey").alias("o_custkey"), "r_name")
        orders = lookup_join(
            self.table("orders"), customers, "o_custkey", "left", self.hot_customers
        ).withColumnRenamed("o_orderkey", "l_orderkey")
        lines = lookup_join(self.lines, orders, "l_orderkey", "left", self.hot_orders)
        # Whole cents and whole percents: exact, and cheaper per row than decimals.
        cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
        percent = F.floor(F.col("l_discount") * 100 + 0.5) * 3
        return lines.select(
            _line_id().alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
            (percent / 100).alias("discount_pct"),
            F.col("l_extendedprice").alias("gross_amount"),
            (cents * (100 - percent) / 10000).alias("net_amount"),
            _day_text("o_orderdate").alias("order_date"),
            F.col("o_orderpriority").alias("channel"),
            F.col("r_name").alias("region"),
            F.when(F.col("l_returnflag") == "R", "Returned")
            .when(F.col("o_orderstatus") == "P", "Cancelled")
            .otherwise("Completed")
            .alias("status"),
            F.datediff("l_shipdate", "o_orderdate").alias("ship_days"),
            _load_ts("l_orderkey").alias("_ingested_at"),
        )

    @cached_property
    def bronze_products(self) -> DataFrame:
        suppliers = (
            self.table("lineitem")
            .groupBy(F.col("l_partkey").alias("p_partkey"))
            .agg(F.min("l_suppkey").alias("first_supplier"))
        )
        return (
            self.table("part")
            .join(suppliers, "p_partkey", "left")
            .select(
                F.col("p_partkey").cast("string").alias("product_id"),
                F.col("p_name").alias("product_name"),
                F.col("p_type").alias("category"),
                F.col("p_brand").alias("subcategory"),
                (F.col("p_retailprice").cast("decimal(12,2)") * F.lit("0.6").cast("decimal(2,1)"))
                .cast("double")
                .alias("cost_price"),
                F.col("p_retailprice").alias("retail_price"),
                F.col("first_supplier").cast("string").alias("supplier_id"),
                F.when(F.col("p_size") > 5, "true").otherwise("false").alias("is_active"),
                _load_ts("p_partkey").alias("_ingested_at"),
            )
        )

    @cached_property
    def bronze_customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._customer_places.select(
            key.cast("string").alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.regexp_replace("c_name", "[^0-9]", "").alias("last_name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias(
                "email"
            ),
            (18 + key % 70).cast("int").alias("age"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("c_mktsegment").alias("segment"),
            F.date_format(
                F.date_sub(F.lit(dt.date(1994, 12, 31)), (key % 1000).cast("int")), "yyyy-MM-dd"
            ).alias("join_date"),
            F.when(F.col("c_acctbal") > 0, "true").otherwise("false").alias("is_active"),
            _load_ts("c_custkey").alias("_ingested_at"),
        )

    @cached_property
    def bronze_inventory(self) -> DataFrame:
        on_hand = F.col("l_quantity").cast("int") - 1
        return self.lines.select(
            _line_id().alias("inventory_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("warehouse_id"),
            _day_text("l_shipdate").alias("snapshot_date"),
            on_hand.alias("quantity_on_hand"),
            F.lit(10).alias("reorder_level"),
            F.when(on_hand < 10, "true").otherwise("false").alias("is_below_reorder"),
            _load_ts("l_orderkey").alias("_ingested_at"),
        )

    def bronze(self, feed: str) -> DataFrame:
        return getattr(self, f"bronze_{feed}")

    @cached_property
    def silver_orders(self) -> DataFrame:
        return silver.silver_orders(self.bronze_orders, self.batch_ts)

    @cached_property
    def silver_customers(self) -> DataFrame:
        return silver.silver_customers(self.bronze_customers, self.as_of, self.batch_ts)

    @cached_property
    def silver_products(self) -> DataFrame:
        return silver.silver_products(self.bronze_products, self.batch_ts)

    @cached_property
    def silver_inventory(self) -> DataFrame:
        return silver.silver_inventory(self.bronze_inventory, self.batch_ts)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.silver_customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return star.dim_product(self.silver_products)

    @cached_property
    def order_lines(self) -> DataFrame:
        """The fact rows before the dimension lookups: enough for order-only reports."""
        return star.order_lines(self.silver_orders)

    @cached_property
    def order_profit(self) -> DataFrame:
        """The fact rows with product cost, for reports that read no customer attribute."""
        return star.with_product(
            self.order_lines, self.dim_product, as_text(self.hot_products)
        )

    @property
    def customer_ids(self) -> DataFrame:
        """Of all orders, with and without lines."""
        return self.table("orders").select(F.col("o_custkey").cast("string").alias("customer_id"))

    @cached_property
    def fact_orders(self) -> DataFrame:
        return star.fact_orders(
            self.silver_orders,
            self.dim_customer,
            self.dim_product,
            hot_customers=as_text(self.hot_customers),
            hot_products=as_text(self.hot_products),
            customer_ids=self.customer_ids,
        )
