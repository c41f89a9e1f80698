"""Streaming ingest and event queries, run to the end of the available input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.catalog.change_queries import MOVED
from shopgrain.catalog.reference_sql import RAW_ORDER_COLUMNS, layer, with_layers
from shopgrain.catalog.registry import query
from shopgrain.session import delete_path, scratch_path
from shopgrain.sources import schemas
from shopgrain.sources.conform import FIRST_LOAD_TS, Retail, ntz
from shopgrain.streaming.events import (
    dedup_stream,
    large_state_session,
    purchases,
    retail_events,
    windowed_revenue,
)
from shopgrain.streaming.ingest import AUDIT, append_to, ingest_csv, read_evolving
from shopgrain.streaming.upsert import read_current, stream_upsert

EVENT_COLUMNS = "event_id, customer_id, event_type, amount, region, event_time"


def write_csv(t: Retail, feed: str, path: str, load: str | None = None) -> None:
    """Put a conformed feed (or one load of it) into a CSV folder, as an upstream system would."""
    rows = t.bronze(feed)
    if load == "first":
        rows = rows.where(F.col("_ingested_at") == ntz(FIRST_LOAD_TS))
    elif load == "second":
        rows = rows.where(F.col("_ingested_at") > ntz(FIRST_LOAD_TS))
    columns = schemas.names(schemas.FEEDS[feed])
    rows.select(*columns).write.mode("append").option("header", True).csv(path)


def ingest(t: Retail, feed: str, typed: bool = True, trigger: dict | None = None) -> DataFrame:
    base = scratch_path(t.spark, f"ingest_{feed}")
    write_csv(t, feed, f"{base}/raw")
    schema = schemas.struct(schemas.FEEDS[feed]) if typed else None
    running = ingest_csv(
        t.spark, f"{base}/raw", schema, f"{base}/table", f"{base}/checkpoint", trigger
    )
    if trigger:
        running.processAllAvailable()
        running.stop()
    running.awaitTermination()
    delete_path(t.spark, f"{base}/raw")
    return read_evolving(t.spark, f"{base}/table")


def feed_sql(feed: str) -> str:
    return layer(f"bronze_{feed}", ", ".join(schemas.names(schemas.FEEDS[feed])))


@query("ingest_csv_stream", layer("bronze_orders", RAW_ORDER_COLUMNS))
def ingest_csv_stream(t: Retail):
    return ingest(t, "orders").drop(*AUDIT)


@query(
    "ingest_csv_untyped",
    with_layers(
        "SELECT customer_id, first_name, last_name, email, CAST(age AS VARCHAR) AS age, city, state, "
        "segment, join_date, is_active FROM bronze_customers",
        "bronze_customers",
    ),
)
def ingest_csv_untyped(t: Retail):
    return ingest(t, "customers", typed=False).drop(*AUDIT)


@query(
    "ingest_audit_columns",
    with_layers(
        "SELECT inventory_id, TRUE AS has_time, TRUE AS has_file FROM bronze_inventory",
        "bronze_inventory",
    ),
)
def ingest_audit_columns(t: Retail):
    return ingest(t, "inventory").select(
        "inventory_id",
        F.col("_ingested_at").isNotNull().alias("has_time"),
        F.col("_source_file").endswith(".csv").alias("has_file"),
    )


@query("stream_trigger", feed_sql("products"))
def stream_trigger(t: Retail):
    rows = ingest(t, "products", trigger={"processingTime": "1 second"})
    return rows.drop(*AUDIT)


@query("stream_restart", feed_sql("customers"))
def stream_restart(t: Retail):
    """Ingest one load, stop, add the other and go on from the checkpoint: no row twice."""
    base = scratch_path(t.spark, "restart")
    schema = schemas.struct(schemas.CUSTOMERS)
    for load in ("first", "second"):
        write_csv(t, "customers", f"{base}/raw", load)
        ingest_csv(
            t.spark, f"{base}/raw", schema, f"{base}/table", f"{base}/checkpoint"
        ).awaitTermination()
    return read_evolving(t.spark, f"{base}/table").drop(*AUDIT)


def event_stream(t: Retail) -> DataFrame:
    # A stream follows a folder; the name filter picks the table, be it one file or a folder.
    rows = t.spark.readStream.schema(t.table("events").schema)
    return retail_events(rows.parquet(f"{t.folder}/events.parque[t]"))


def run(t: Retail, stream: DataFrame, label: str) -> str:
    """Append a stream to a fresh table until its input is used up; returns the table's path."""
    base = scratch_path(t.spark, label)
    append_to(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return f"{base}/table"


def ntz_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "stream_append_sink",
    with_layers(f"SELECT {EVENT_COLUMNS} FROM events_conformed", "events_conformed"),
)
def stream_append_sink(t: Retail):
    return ntz_columns(t.spark.read.parquet(run(t, event_stream(t), "events")), "event_time")


@query(
    "stream_filter_project",
    with_layers(
        "SELECT event_id, customer_id, amount, region FROM events_conformed "
        "WHERE event_type = 'purchase'",
        "events_conformed",
    ),
)
def stream_filter_project(t: Retail):
    stream = purchases(event_stream(t)).select("event_id", "customer_id", "amount", "region")
    return t.spark.read.parquet(run(t, stream, "purchases"))


@query("sliding_window_batch", layer("sliding_windows"))
def sliding_window_batch(t: Retail):
    windows = windowed_revenue(retail_events(t.table("events")), watermark=None)
    return ntz_columns(windows, "window_start", "window_end")


@query("stream_append_window_agg", layer("finished_windows"))
def stream_append_window_agg(t: Retail):
    path = run(t, windowed_revenue(event_stream(t)), "window_agg")
    return ntz_columns(t.spark.read.parquet(path), "window_start", "window_end")


@query("bronze_realtime_agg", layer("finished_windows"))
def bronze_realtime_agg(t: Retail):
    """Raw events land in a table first; the revenue windows follow that table as a stream."""
    landed = run(t, event_stream(t), "bronze_events")
    schema = t.spark.read.parquet(landed).schema
    follow = t.spark.readStream.schema(schema).parquet(landed)
    path = run(t, windowed_revenue(follow), "realtime_agg")
    return ntz_columns(t.spark.read.parquet(path), "window_start", "window_end")


@query(
    "stream_chain",
    with_layers(
        "SELECT event_id, customer_id, amount FROM events_conformed WHERE event_type = 'purchase'",
        "events_conformed",
    ),
)
def stream_chain(t: Retail):
    landed = run(t, event_stream(t), "bronze_events")
    schema = t.spark.read.parquet(landed).schema
    follow = purchases(t.spark.readStream.schema(schema).parquet(landed))
    return t.spark.read.parquet(
        run(t, follow.select("event_id", "customer_id", "amount"), "silver_events")
    )


@query(
    "stream_dedup_key",
    with_layers("SELECT DISTINCT customer_id FROM events_conformed", "events_conformed"),
)
def stream_dedup_key(t: Retail):
    """State grows with the number of keys for as long as the stream runs, so it lives on disk."""
    t = Retail(large_state_session(t.spark), t.folder)
    stream = dedup_stream(event_stream(t).select("customer_id", "event_id"), ["customer_id"])
    return t.spark.read.parquet(run(t, stream, "dedup")).select("customer_id")


@query(
    "stream_upsert_foreach_batch",
    with_layers(
        f"""SELECT customer_id, city, CASE WHEN {MOVED} THEN 'PREMIUM' ELSE segment END AS segment
        FROM silver_customers""",
        "silver_customers",
    ),
)
def stream_upsert_foreach_batch(t: Retail):
    """A full load, then a batch of changes, merged by one checkpointed query."""
    base = scratch_path(t.spark, "upsert")
    columns = ["customer_id", "city", "segment", "_ingested_at"]
    customers = t.silver_customers.select(*columns)
    moved = customers.where(MOVED).withColumn("segment", F.lit("PREMIUM"))
    for changes in (customers, moved):
        changes.write.mode("append").parquet(f"{base}/changes")
        source = t.spark.readStream.schema(customers.schema).parquet(f"{base}/changes")
        stream_upsert(
            source,
            f"{base}/table",
            ["customer_id"],
            f"{base}/checkpoint",
            order=[F.desc("_ingested_at")],
        ).awaitTermination()
    return read_current(t.spark, f"{base}/table").drop("_ingested_at")
