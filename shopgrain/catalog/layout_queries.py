"""Compaction, clustering and profiles, each checked by what it must not change."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopgrain.catalog.reference_sql import total, with_layers
from shopgrain.catalog.registry import query
from shopgrain.functions import money_sum
from shopgrain.operators import layout
from shopgrain.session import delete_path, scratch_path
from shopgrain.sources.conform import Retail


@query(
    "compact_files",
    f"""SELECT l_returnflag, COUNT(*) AS n, {total("l_extendedprice")} AS price, TRUE AS fewer_files
    FROM lineitem GROUP BY 1""",
)
def compact_files(t: Retail):
    small, large = scratch_path(t.spark, "small_files"), scratch_path(t.spark, "compacted")
    lines = t.table("lineitem")
    lines.repartition(4 * max(2, lines.rdd.getNumPartitions())).write.parquet(small)
    compacted = layout.compact(t.spark, small, large)
    before, after = (layout.file_sizes(t.spark, p).count() for p in (small, large))
    delete_path(t.spark, small)
    return compacted.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(money_sum("l_extendedprice"), 2).cast("double").alias("price"),
        F.lit(after < before).alias("fewer_files"),
    )


@query(
    "zorder_layout",
    with_layers(
        f"""SELECT region, order_year, COUNT(*) AS n, {total("net_amount")} AS revenue
        FROM silver_orders GROUP BY 1, 2""",
        "silver_orders",
    ),
)
def zorder_layout(t: Retail):
    staged = scratch_path(t.spark, "silver_orders")
    t.silver_orders.write.parquet(staged)
    clustered = layout.zorder(
        t.spark.read.parquet(staged),
        scratch_path(t.spark, "clustered"),
        ["order_date", "region", "product_id"],
    )
    delete_path(t.spark, staged)
    return clustered.groupBy("region", "order_year").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(money_sum("net_amount"), 2).cast("double").alias("revenue"),
    )


PROFILED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "column_statistics",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, "
        f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value, "
        f"COUNT(DISTINCT {c}) AS distinct_count FROM orders"
        for c in PROFILED
    ),
)
def column_statistics(t: Retail):
    return layout.column_statistics(t.table("orders"), list(PROFILED))


@query(
    "column_statistics_sketch",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, "
        f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value, "
        f"COUNT(DISTINCT {c}) AS distinct_count, TRUE AS within_bound FROM orders"
        for c in PROFILED
    ),
)
def column_statistics_sketch(t: Retail):
    """The one-pass profile, with the exact distinct counts beside and whether the estimates keep their bound."""
    orders = t.table("orders")
    told = layout.column_statistics(orders, list(PROFILED), exact=False).withColumnRenamed("distinct_count", "estimate")
    exact = layout.column_statistics(orders, list(PROFILED)).select("column_name", "distinct_count")
    off = F.abs(F.col("estimate") - F.col("distinct_count"))
    close = off <= F.greatest(F.lit(1.0), F.col("distinct_count") * layout.SKETCH_ERROR)
    return told.join(exact, "column_name").withColumn("within_bound", close).drop("estimate")
