"""Cleaned tables kept by a stream: bounded state, late rows, replays, metrics per micro-batch."""

import datetime as dt
import json

from pyspark.sql import functions as F

from shopgrain.operators.quality import FAILED_RULES, Rule
from shopgrain.session import scratch_path
from shopgrain.streaming.events import LARGE_STATE, ROCKSDB
from shopgrain.streaming.expect import (
    BOUNDED_STATE,
    COUNTED_STATE,
    expect_stream,
    read_kept,
    read_quarantined,
    read_report,
    write_checked,
)

RULES = [Rule("key", "k IS NOT NULL"), Rule("positive", "v > 0"), Rule("small", "v < 100", "warn")]
SCHEMA = "k string, v int, _ingested_at timestamp"


def day(n, hour=0):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n)


class Feed:
    def __init__(self, spark):
        self.spark, self.base = spark, scratch_path(spark, "expect")

    def run(self, *rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/in")
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.base}/in")
        query = expect_stream(stream, "k", RULES, f"{self.base}/out", f"{self.base}/cp", watermark="2 days")
        query.awaitTermination()
        return query

    def kept(self):
        return sorted((r.k, r.v) for r in read_kept(self.spark, f"{self.base}/out").collect())

    def report(self):
        lines = read_report(self.spark, f"{self.base}/out", RULES).collect()
        return {r.rule: (r.passed, r.failed, r.dropped) for r in lines}


def test_duplicates_rules_and_replay(spark):
    feed = Feed(spark)
    feed.run(("a", 1, day(0)), ("a", 1, day(0)), ("b", 0, day(0)), (None, 5, day(0)), ("c", 200, day(0)))
    assert feed.kept() == [("a", 1), ("c", 200)]
    feed.run(("a", 9, day(0, 5)), ("d", None, day(0, 5)), ("e", 3, day(0, 5)))
    assert feed.kept() == [("a", 1), ("c", 200), ("e", 3)]
    out = f"{feed.base}/out"
    broken = {(r.k, tuple(r[FAILED_RULES])) for r in read_quarantined(spark, out).collect()}
    assert broken == {("b", ("positive",)), (None, ("key",)), ("d", ("positive",))}
    want = {"key": (5, 1, 1), "positive": (4, 2, 2), "small": (4, 2, 0)}
    assert feed.report() == want
    # A batch that is delivered again replaces its own folders.
    batch = max(int(r.batch) for r in spark.read.parquet(f"{out}/rows").select("batch").distinct().collect())
    rows = spark.read.parquet(f"{out}/rows").where(F.col("batch") == batch).select("k", "v", "_ingested_at")
    write_checked(spark.createDataFrame(rows.collect(), SCHEMA), batch, out, RULES)
    assert feed.report() == want and feed.kept() == [("a", 1), ("c", 200), ("e", 3)]


def test_state_is_bounded_by_the_watermark(spark):
    feed = Feed(spark)
    sizes = []
    for n in range(0, 30, 3):
        query = feed.run(*[(f"{n}-{i}", 1, day(n)) for i in range(20)])
        state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        sizes.append(state[-1])
    assert len(feed.kept()) == 200
    assert max(sizes) <= 60
    late = feed.run(("late", 1, day(1)), ("0-0", 1, day(28)))
    kept = feed.kept()
    assert ("late", 1) not in kept  # behind the watermark
    assert kept.count(("0-0", 1)) == 2  # a copy further apart than the watermark counts as new
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in late.recentProgress if p["stateOperators"]) == 1


def test_state_is_kept_beside_the_heap(spark):
    feed, names = Feed(spark), (*LARGE_STATE, *BOUNDED_STATE, COUNTED_STATE)
    before = [spark.conf.get(n, None) for n in names]
    query = feed.run(("a", 1, day(0)), ("b", 1, day(0)))
    started = json.loads(spark.read.text(f"{feed.base}/cp/offsets/0").collect()[1][0])["conf"]
    assert started["spark.sql.streaming.stateStore.providerClass"] == ROCKSDB
    custom = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
    assert custom and all(any(name.startswith("rocksdb") for name in c) for c in custom)
    assert [spark.conf.get(n, None) for n in names] == before
    feed.run(("a", 2, day(0)), ("c", 1, day(0)))
    assert feed.kept() == [("a", 1), ("b", 1), ("c", 1)]


def test_second_load_and_change_batch_read_the_feed_once(spark, sf_dir):
    from shopgrain.catalog.change_queries import cdc_batch
    from shopgrain.catalog.quality_checks import broken_feed, picked
    from shopgrain.catalog.silver_streams import AGAIN, TWICE, second_load
    from shopgrain.sources.conform import FIRST_LOAD_TS, SECOND_LOAD_TS, Retail, ntz

    t = Retail(spark, sf_dir)
    rows = broken_feed(t, "orders")
    load = second_load(rows, "orders")
    for once in (load, cdc_batch(t)):
        assert "Union" not in once._jdf.queryExecution().optimizedPlan().toString()
    first = rows.where(F.col("_ingested_at") == ntz(FIRST_LOAD_TS))
    second = rows.where(F.col("_ingested_at") == ntz(SECOND_LOAD_TS))
    again = first.where(picked("orders", AGAIN)).withColumn("_ingested_at", ntz(SECOND_LOAD_TS))
    want = second.unionByName(again).unionByName(second.where(picked("orders", TWICE)))
    assert load.exceptAll(want).count() == 0 and want.exceptAll(load).count() == 0 and again.count() > 0


def test_both_loads_come_from_one_pass_over_the_feed(spark, sf_dir, monkeypatch):
    from shopgrain.catalog import silver_streams
    from shopgrain.sources.conform import Retail

    t, passes = Retail(spark, sf_dir), []
    feed = silver_streams.broken_feed
    monkeypatch.setattr(silver_streams, "broken_feed", lambda t, name: passes.append(feed(t, name)) or passes[-1])
    written = []
    numbered = silver_streams.loads
    monkeypatch.setattr(silver_streams, "loads", lambda rows, name: written.append(numbered(rows, name)) or written[-1])
    table = silver_streams.follow(t, "inventory")
    assert len(passes) == len(written) == 1
    raw = spark.read.parquet(f"{table.removesuffix('/table')}/raw/*")
    rows = written[0].drop(silver_streams.LOAD)
    assert raw.exceptAll(rows).count() == 0 and rows.exceptAll(raw).count() == 0
    assert raw.count() > passes[0].count()  # what comes again or twice
    assert spark.read.parquet(f"{table}/report").count() >= 2  # a micro-batch a load
