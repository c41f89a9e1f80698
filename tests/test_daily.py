"""The daily job, run from empty and then incrementally."""

import os
import time

from pyspark.sql import functions as F

from shopgrain.plans import daily
from shopgrain.session import PARQUET_CODEC, SHUFFLE_CLEANUP, materialize, scratch_path, shuffles_dropped
from shopgrain.sources.conform import FIRST_LOAD_TS, Retail, ntz

FEEDS = ("orders", "customers", "products", "inventory")


def test_incremental_run_ends_where_a_full_run_does(spark, sf_dir):
    t = Retail(spark, sf_dir)
    everything = {f: t.bronze(f) for f in FEEDS}
    first_load = {f: df.where(F.col("_ingested_at") == ntz(FIRST_LOAD_TS)) for f, df in everything.items()}
    first, second, full = (scratch_path(spark, n) for n in ("first", "second", "full"))
    daily.refresh(spark, first_load, first, t.as_of, t.batch_ts)
    tables = daily.refresh(spark, everything, second, t.as_of, t.batch_ts, previous=first)
    assert daily.refresh(spark, everything, full, t.as_of, t.batch_ts) == tables
    for name in tables:
        a, b = (spark.read.parquet(f"{root}/{name}") for root in (second, full))
        if name == "gold_forecast":
            assert a.count() == b.count() == 90
            continue
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    failures = spark.read.parquet(f"{full}/quality_report").agg(F.sum("failures")).first()[0]
    assert failures >= 0


def test_refresh_keeps_its_tables_only(spark, sf_dir):
    t = Retail(spark, sf_dir)
    rows = {f: t.bronze(f) for f in FEEDS}
    early = {f: df.where(F.col("_ingested_at") == ntz(FIRST_LOAD_TS)) for f, df in rows.items()}
    first, second = (scratch_path(spark, n) for n in ("first", "second"))
    scratch, codec = os.path.dirname(first), spark.conf.get(PARQUET_CODEC)
    kept = set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    daily.refresh(spark, early, first, t.as_of, t.batch_ts)
    daily.refresh(spark, rows, second, t.as_of, t.batch_ts, previous=first)
    assert set(os.listdir(scratch)) - kept == {os.path.basename(first), os.path.basename(second)}
    assert spark.conf.get(PARQUET_CODEC) == codec
    files = [f for _, _, names in os.walk(second) for f in names if f.endswith(".parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_written_tables_leave_no_shuffle_files(spark):
    # Blocks of shuffles that the driver still knows of; the listing of a removed one is empty.
    def blocks():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(b.isShuffle() for b in (found.apply(i) for found in [manager.getAllBlocks()] for i in range(found.size())))

    def settled(most):
        for _ in range(50):  # the files are removed in the background
            if blocks() <= most:
                return True
            time.sleep(0.1)
        return False

    rows = spark.range(1000).repartition(5, "id").groupBy(F.col("id") % 7).count()
    before = blocks()
    setting = spark.conf.get(SHUFFLE_CLEANUP, None)
    kept = materialize(rows, "kept")
    assert settled(before) and kept.count() == 7
    with shuffles_dropped(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
