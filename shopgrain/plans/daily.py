"""The daily refresh: new raw rows to cleaned tables, star schema, reports, history, forecast.

Each run writes its tables to a folder of its own and reads the previous run's folder, so no
table is overwritten while it is read and a failed run can simply be started again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.operators import forecast, quality
from shopgrain.operators.changes import latest_of_repeated, new_rows, scd2, upsert
from shopgrain.operators.joins import hot_keys
from shopgrain.plans import declared, gold, silver, star
from shopgrain.session import PARQUET_CODEC, scratch_noted, setting, shuffles_dropped
from shopgrain.sources import schemas

LOAD_TS = "_ingested_at"


def snapshot(customers: DataFrame) -> DataFrame:
    masked = customers.drop("email").withColumnRenamed("email_masked", "email")
    return masked.select(*declared.SNAPSHOT_COLUMNS)


def refresh(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    root: str,
    as_of: Column,
    batch_ts: Column,
    previous: str | None = None,
    horizon: int = forecast.HORIZON_DAYS,
) -> list[str]:
    """Run all steps below ``root``; returns the names of the tables written.

    ``bronze`` maps orders, customers, products and inventory to their raw rows. With
    ``previous`` only rows loaded since that run are cleaned and merged.

    The tables are packed with zstd, and what a step needed beside them is removed as soon as it is written.
    """
    with setting(spark, PARQUET_CODEC, "zstd"), scratch_noted(spark) as drop_scratch:
        return _steps(spark, bronze, root, as_of, batch_ts, previous, horizon, drop_scratch)


def _steps(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    root: str,
    as_of: Column,
    batch_ts: Column,
    previous: str | None,
    horizon: int,
    drop_scratch: Callable[[], None],
) -> list[str]:
    written: list[str] = []

    def read(table: str, folder: str = root) -> DataFrame:
        return spark.read.parquet(f"{folder}/{table}")

    def write(table: str, df: DataFrame, by: str | None = None) -> DataFrame:
        with shuffles_dropped(spark):
            (df.write.partitionBy(by) if by else df.write).parquet(f"{root}/{table}")
        drop_scratch()
        written.append(table)
        return read(table)

    clean = {
        "orders": lambda rows: silver.silver_orders(rows, batch_ts),
        "customers": lambda rows: silver.silver_customers(rows, as_of, batch_ts),
        "products": lambda rows: silver.silver_products(rows, batch_ts),
        "inventory": lambda rows: silver.silver_inventory(rows, batch_ts),
    }
    tables = {}
    for feed, cleaner in clean.items():
        target = read(f"silver_{feed}", previous) if previous else None
        changes = cleaner(new_rows(bronze[feed], target, LOAD_TS))
        order = [F.desc_nulls_last(LOAD_TS)]
        image = upsert(target, changes, [schemas.KEYS[feed]], order=order, latest=latest_of_repeated)
        tables[feed] = write(f"silver_{feed}", image)
    quality.assert_contract(tables["orders"], schemas.struct(declared.ORDER_CONTRACT))
    checks = [
        quality.run_tests(tables[name.removeprefix("silver_")], tests, name)
        for name, tests in declared.SILVER_TESTS.items()
    ]
    write("quality_report", reduce(DataFrame.unionByName, checks))

    customers = write("dim_customer", star.dim_customer(tables["customers"]))
    products = write("dim_product", star.dim_product(tables["products"]))
    days = tables["orders"].agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    write("dim_date", star.dim_date(star.date_spine(days, "first", F.date_add("last", 1))))
    hot_products = hot_keys(tables["orders"], "product_id")
    fact = write(
        "fact_orders",
        star.fact_orders(
            tables["orders"],
            customers,
            products,
            hot_customers=hot_keys(tables["orders"], "customer_id"),
            hot_products=hot_products,
            # Adaptive execution evens out the files: large months split, small ones share.
            rebalance_by="order_month_key",
        ),
        by="order_month_key",
    )

    # The upsert above leaves one row per order, and the dimension joins keep it so.
    sales = write("gold_daily_sales", gold.daily_sales(fact, orders_unique=True))
    write("gold_product_performance", gold.product_performance(fact, products, orders_unique=True))
    write("gold_customer_rfm", gold.customer_rfm(fact, customers, as_of, orders_unique=True))
    write("gold_inventory_health", gold.inventory_health(tables["inventory"], products, hot_products))

    history = read("scd_customers", previous) if previous else None
    current = snapshot(tables["customers"])
    write("scd_customers", scd2(history, current, "customer_id", declared.SNAPSHOT_CHECKS))

    train, _ = forecast.split(forecast.fill_days(forecast.daily_series(sales, [])))
    write("gold_forecast", forecast.as_report(forecast.fit_predict_one(train, horizon)))
    return written
