"""Cleaned tables kept by a stream: deduplication with bounded state, rules, quarantine and report.

One query writes it all. Micro-batch ``n`` writes its rows below ``rows/batch=n``, kept and quarantined ones
apart, and what it counted below ``report/batch=n``; a batch that is delivered again replaces its own folders.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import ExitStack

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopgrain.operators.quality import FAILED_RULES, Rule, broken_rules, rule_counts, rule_lines
from shopgrain.session import setting
from shopgrain.streaming.events import LARGE_STATE, dedup_within
from shopgrain.streaming.ingest import AVAILABLE_NOW

KEPT, BATCH = "_kept", "batch"
#: All state stores of an executor share this much memory, beside the heap.
BOUNDED_STATE = {
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "2000",
}
COUNTED_STATE = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def write_checked(batch: DataFrame, batch_id: int, root: str, rules: list[Rule]) -> None:
    """One pass: the rows go to both sinks, and the rules are counted as they go by."""
    seen = Observation()
    marked = batch.withColumn(FAILED_RULES, broken_rules(rules)).withColumn(KEPT, (F.size(FAILED_RULES) == 0).cast("int"))
    counted = marked.observe(seen, *rule_counts(rules))
    counted.write.mode("overwrite").option("compression", "zstd").partitionBy(KEPT).parquet(f"{root}/rows/{BATCH}={batch_id}")
    counts = seen.get
    names = ["total", *(f"failed_{i}" for i in range(len(rules)))]
    line = batch.sparkSession.createDataFrame(
        [tuple(int(counts.get(n) or 0) for n in names)], ", ".join(f"{n} long" for n in names)
    )
    line.coalesce(1).write.mode("overwrite").parquet(f"{root}/report/{BATCH}={batch_id}")


def expect_stream(
    rows: DataFrame,
    key: str,
    rules: Iterable[Rule],
    root: str,
    checkpoint: str,
    ts_col: str = "_ingested_at",
    watermark: str = "1 day",
    trigger: dict | None = None,
    count_state: bool = True,
) -> StreamingQuery:
    """Check a stream of cleaned rows against ``rules`` and keep the first row of each key.

    A key is remembered until the watermark, ``watermark`` behind the newest ``ts_col``, has passed its row: copies
    that come further apart count as new, rows behind the watermark are left out. State is bounded by the keys
    of that span and kept in RocksDB, on the executors' disks. Null keys count as one key. ``ts_col`` is a TIMESTAMP.
    ``count_state`` has the progress tell the number of remembered keys, which costs one more look-up for each row.
    """
    rules = list(rules)
    writer = (
        dedup_within(rows, [key], ts_col, watermark)
        .writeStream.foreachBatch(lambda batch, n: write_checked(batch, n, root, rules))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
    )
    with ExitStack() as held:  # a query keeps the settings that it starts with
        counted = {COUNTED_STATE: str(count_state).lower()}
        for name, value in {**LARGE_STATE, **BOUNDED_STATE, **counted}.items():
            held.enter_context(setting(rows.sparkSession, name, value))
        return writer.start()


def read_kept(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rows").where(f"{KEPT} = 1").drop(KEPT, BATCH, FAILED_RULES)


def read_quarantined(spark: SparkSession, root: str) -> DataFrame:
    """The other rows, with the names of the rules they break."""
    return spark.read.parquet(f"{root}/rows").where(f"{KEPT} = 0").drop(KEPT, BATCH)


def read_report(spark: SparkSession, root: str, rules: Iterable[Rule]) -> DataFrame:
    """One line per rule over all batches; the batches' own counts stay below ``report``."""
    rules = list(rules)
    counts = spark.read.parquet(f"{root}/report")
    names = ["total", *(f"failed_{i}" for i in range(len(rules)))]
    return counts.agg(*[F.sum(n).alias(n) for n in names]).select(rule_lines(rules))
