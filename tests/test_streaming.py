import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopgrain.session import scratch_path
from shopgrain.sources import schemas
from shopgrain.streaming.events import dedup_stream, dedup_within, windowed_revenue
from shopgrain.streaming.ingest import append_evolving, append_to, column_names, ingest_csv, parse_by_name, read_evolving
from shopgrain.streaming.upsert import read_current, stream_upsert, write_version

EVENTS = "event_id string, event_type string, amount double, region string, event_time timestamp"


class Feed:
    """A folder that grows file by file and is followed as a stream."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.base = scratch_path(spark, "test")

    def add(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(
            f"{self.base}/in"
        )

    def stream(self):
        return self.spark.readStream.schema(schemas.struct(self.schema)).parquet(f"{self.base}/in")

    def run(self, transform):
        append_to(transform(self.stream()), f"{self.base}/out", f"{self.base}/cp").awaitTermination()
        return self.spark.read.parquet(f"{self.base}/out")


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 0, minute, second)


def test_windows_close_and_late_rows_are_dropped(spark):
    feed = Feed(spark, EVENTS)
    buy = lambda i, *t: (i, "purchase", 1.0, "N", at(*t))
    feed.add(buy("a", 1), buy("b", 2), buy("c", 30), ("x", "view", 9.0, "N", at(59)))
    out = feed.run(windowed_revenue)
    # The watermark is 10 minutes behind the last purchase; the view does not move it.
    assert {r.window_end.minute for r in out.collect()} == {2, 3, 4, 5, 6, 7}
    feed.add(buy("late", 3), buy("d", 50))
    out = feed.run(windowed_revenue)
    early = out.where(F.col("window_end") <= F.lit(at(7))).agg(F.sum("purchase_count")).first()[0]
    assert early == 10  # a and b in five windows each; the late one is in none
    assert out.groupBy("window_start", "region").count().where("count > 1").count() == 0


def test_dedup_across_batches_with_a_hot_key(spark):
    feed = Feed(spark, "k string, v int")
    feed.add(*[("hot", i) for i in range(200)], ("a", 1))
    assert feed.run(lambda s: dedup_stream(s, ["k"], salts=4)).count() == 2
    feed.add(*[("hot", i) for i in range(50)], ("b", 1))
    out = feed.run(lambda s: dedup_stream(s, ["k"], salts=4))
    assert sorted(r.k for r in out.collect()) == ["a", "b", "hot"]


def test_dedup_within_watermark(spark):
    feed = Feed(spark, EVENTS)
    feed.add(("a", "view", 1.0, "N", at(1)), ("a", "view", 1.0, "N", at(2)), ("b", "view", 1.0, "N", at(3)))
    out = feed.run(lambda s: dedup_within(s, ["event_id"], "event_time", "10 minutes"))
    assert out.count() == 2


def test_csv_restart_and_untyped(spark):
    base = scratch_path(spark, "csv")
    people = spark.createDataFrame([("1", "a", 3)], "customer_id string, name string, age int")

    def add(df):
        df.write.mode("append").option("header", True).csv(f"{base}/in")

    def run(schema, sink):
        ingest_csv(spark, f"{base}/in", schema, f"{base}/{sink}", f"{base}/cp_{sink}").awaitTermination()
        return read_evolving(spark, f"{base}/{sink}")

    add(people)
    typed = schemas.struct("customer_id string, name string, age int")
    assert run(typed, "typed").count() == 1
    assert run(typed, "typed").count() == 1
    add(people.withColumn("customer_id", F.lit("2")))
    out = run(typed, "typed")
    assert out.count() == 2 and out.select("_source_file").distinct().count() == 2
    assert dict(run(None, "untyped").dtypes)["age"] == "string"


def csv_files(spark, **files):
    """A folder with one file for each name."""
    base = scratch_path(spark, "csv")
    jvm = spark._jvm
    for name, text in files.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{base}/in", f"{name}.csv")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(text.encode())
        out.close()
    return base


def test_csv_files_of_several_headers_are_scanned_once(spark):
    base = csv_files(
        spark, a="id,name\n1,ann\n\n", b="name,id,vip\nbob,2,yes\n", c="\nID\n3\nID\n", empty="", d="id,name\n"
    )
    files = [f"{base}/in/{n}.csv" for n in ("a", "b", "c", "empty", "d")]
    schema = schemas.struct("id int, name string")
    got = parse_by_name(spark, files, schema)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert sorted((r.id, r.name) for r in got.collect()) == [(1, "ann"), (2, "bob"), (3, None)]
    few = parse_by_name(spark, files, schema, headers_per_scan=2)
    assert sorted(few.drop("_ingested_at").collect(), key=repr) == sorted(got.drop("_ingested_at").collect(), key=repr)
    assert parse_by_name(spark, [f"{base}/in/empty.csv"], schema) is None


def test_csv_lines_are_parsed_once_per_header(spark, tmp_path):
    schema = "id int, v int, note string"
    for name, header in (("a", "id,v,note"), ("b", "v,id,other")):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n1,2,x\n2,broken,y\n3\n")
    files = [f"file:{tmp_path}/{n}.csv" for n in "ab"]
    got = parse_by_name(spark, files, spark.createDataFrame([], schema).schema)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 2
    found = {(r.id, r.v, r.note, r._corrupt_record) for r in got.collect()}
    assert found == {
        (1, 2, "x", None), (2, None, "y", "2,broken,y"), (3, None, None, "3"), (2, 1, None, None),
        (None, 2, None, "2,broken,y"), (None, 3, None, "3"),
    }


def test_csv_names_that_repeat_or_lack_are_all_kept(spark):
    assert column_names("id,name,ID,id_2,,id") == ["id", "name", "ID_3", "id_2", "_c4", "id_4"]
    base = csv_files(spark, **{"a b [1]": "id,name,id\n1,bob,2\n", "c%20{d}": "Id,\n5,6\n"})

    def run(schema, sink):
        ingest_csv(spark, f"{base}/in", schema, f"{base}/{sink}", f"{base}/cp_{sink}", max_files=1).awaitTermination()
        return read_evolving(spark, f"{base}/{sink}")

    typed = {r.id: r for r in run(schemas.struct("id int, name string"), "typed").collect()}
    assert typed[1].name == "bob" and typed[1]._extra_columns == {"id_2": "2"} and typed[1]._corrupt_record is None
    assert typed[5]._extra_columns == {"_c1": "6"}
    both = parse_by_name(spark, [r.path for r in spark.read.format("binaryFile").load(f"{base}/in").select("path").collect()], None)
    assert both.columns[:4] == ["Id", "_c1", "name", "id_2"]
    assert sorted(tuple(r[:4]) for r in both.collect()) == [("1", None, "bob", "2"), ("5", "6", None, None)]


def test_csv_columns_go_by_name_and_nothing_is_lost(spark):
    base = scratch_path(spark, "csv")
    schema = schemas.struct("id string, name string, age int")

    def add(name, *lines):
        rows = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
        rows.write.mode("append").text(f"{base}/in")

    def run(kind, sink):
        ingest_csv(spark, f"{base}/in", kind, f"{base}/{sink}", f"{base}/cp_{sink}").awaitTermination()
        return read_evolving(spark, f"{base}/{sink}")

    add("a", "id,name,age", "1,ann,30", '007,"b, c",41')
    add("b", "name,id,age,vip", "bob,2,20,yes")
    run(schema, "typed")
    add("c", "id,age", "3,old", "4", "5,6,7")
    got = {r.id: r for r in run(schema, "typed").collect()}
    assert {k: (r.name, r.age) for k, r in got.items()} == {
        "1": ("ann", 30), "007": ("b, c", 41), "2": ("bob", 20), "3": (None, None), "4": (None, None), "5": (None, 6),
    }
    assert got["2"]._extra_columns == {"vip": "yes"} and got["1"]._extra_columns is None
    assert {k: r._corrupt_record for k, r in got.items() if r._corrupt_record} == {"3": "3,old", "4": "4", "5": "5,6,7"}
    text = run(None, "text")
    assert {"id", "name", "age", "vip"} <= set(text.columns) and text.count() == 6
    assert {r.id: r.vip for r in text.collect()}["2"] == "yes"


def test_evolving_columns(spark):
    base = scratch_path(spark, "evolving")
    spark.range(2).write.parquet(f"{base}/t")
    spark.range(2, 3).withColumn("extra", F.lit("x")).write.mode("append").parquet(f"{base}/t")
    assert {(r.id, r.extra) for r in read_evolving(spark, f"{base}/t").collect()} == {
        (0, None),
        (1, None),
        (2, "x"),
    }
    old = spark.range(1).select("id")
    assert append_evolving(old, old.withColumn("e", F.lit(1))).columns == ["id", "e"]


@pytest.fixture
def upserts(spark):
    return Feed(spark, "k string, v int")


def test_stream_upsert_and_replay(spark, upserts, rows):
    table = f"{upserts.base}/table"

    def run():
        stream_upsert(
            upserts.stream(), table, ["k"], f"{upserts.base}/cp", order=[F.desc("v")], n_buckets=4
        ).awaitTermination()
        return read_current(spark, table)

    upserts.add(("a", 1), ("b", 1), ("a", 0))
    assert rows(run(), "k", "v") == [("a", 1), ("b", 1)]
    upserts.add(("b", 5), ("c", 5))
    assert rows(run(), "k", "v") == [("a", 1), ("b", 5), ("c", 5)]
    # A batch that is delivered again rewrites its own version only.
    replay = spark.createDataFrame([("b", 5), ("c", 5)], "k string, v int")
    write_version(replay, 1, table, ["k"], 4, [F.desc("v")])
    assert rows(read_current(spark, table), "k", "v") == [("a", 1), ("b", 5), ("c", 5)]
    assert rows(read_current(spark, table, before=1), "k", "v") == [("a", 1), ("b", 1)]
