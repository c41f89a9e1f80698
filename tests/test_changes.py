"""Keyed change operators on small fixtures."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopgrain.operators import changes
from shopgrain.session import materialize

SCHEMA = "k string, v int, at int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_upsert_cases(spark, rows):
    target = frame(spark, ("a", 1, 0), ("b", 2, 0))
    source = frame(spark, ("b", 20, 1), ("c", 30, 1))
    assert rows(changes.upsert(target, source, ["k"])) == [("a", 1, 0), ("b", 20, 1), ("c", 30, 1)]
    assert rows(changes.upsert(None, source, ["k"])) == [("b", 20, 1), ("c", 30, 1)]
    assert rows(changes.upsert(target, source.limit(0), ["k"])) == rows(target)
    assert rows(changes.upsert(target, source, ["k"], insert=False)) == [("a", 1, 0), ("b", 20, 1)]
    assert rows(changes.upsert(target, source, ["k"], delete_unmatched=True)) == rows(source)
    assert rows(changes.upsert(target, source, ["k"], update_cols=["v"])) == [
        ("a", 1, 0),
        ("b", 20, 0),
        ("c", 30, 1),
    ]
    assert rows(
        changes.upsert(target, source, ["k"], update_cols=["v"], insert=False, delete_unmatched=True)
    ) == [("b", 20, 0)]


def test_upsert_reduces_the_source_first(spark, rows):
    source = frame(spark, ("a", 1, 1), ("a", 2, 2), ("a", 3, 2))
    merged = changes.upsert(frame(spark, ("a", 0, 0)), source, ["k"], order=[F.desc("at")])
    (row,) = rows(merged)
    assert row[2] == 2
    # Equal timestamps: the same survivor whatever the input order.
    again = changes.upsert(None, source.orderBy("v").coalesce(1), ["k"], order=[F.desc("at")])
    assert rows(again) == [row]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9), max_size=6),
    st.lists(st.tuples(st.sampled_from("abcdefgh"), st.integers(0, 9)), max_size=8),
)
def test_upsert_matches_a_dictionary(spark, rows, target, batch):
    df = frame(spark, *[(k, v, 0) for k, v in target.items()])
    source = frame(spark, *[(k, v, i) for i, (k, v) in enumerate(batch)])
    once = changes.upsert(df, source, ["k"], order=[F.desc("at")]).select("k", "v")
    assert dict(rows(once)) == {**target, **dict(batch)}
    twice = changes.upsert(
        changes.upsert(df, source, ["k"], order=[F.desc("at")]), source, ["k"], order=[F.desc("at")]
    )
    assert rows(twice, "k", "v") == rows(once)


def test_new_rows(spark, rows):
    source = frame(spark, ("a", 1, 1), ("b", 1, 2), ("c", 1, 3)).withColumn(
        "at", F.timestamp_seconds("at")
    )
    target = source.where("k <> 'c'")
    assert rows(changes.new_rows(source, target, "at"), "k") == [("c",)]
    assert rows(changes.new_rows(source, target, "at", inclusive=True), "k") == [("b",), ("c",)]
    assert changes.new_rows(source, target.limit(0), "at").count() == 3
    assert changes.new_rows(source, None, "at").count() == 3


def test_soft_deleted_row_returns_when_merged_again(spark, rows):
    target = frame(spark, ("a", 1, 0), ("b", 2, 0)).withColumns(
        {"is_deleted": F.lit(False), "_updated_at": F.lit(0)}
    )
    deleted = changes.soft_delete(target, frame(spark, ("a", 0, 0), ("a", 0, 0)), ["k"], F.lit(9))
    assert rows(deleted, "k", "is_deleted", "_updated_at") == [("a", True, 9), ("b", False, 0)]
    revived = changes.upsert(deleted, target.where("k = 'a'"), ["k"])
    assert rows(revived, "k", "is_deleted") == [("a", False), ("b", False)]


def people(spark, day, *rows):
    df = spark.createDataFrame(list(rows), "id string, segment string, city string, name string")
    return df.withColumn("_updated_at", F.lit(dt.datetime(2024, 1, day)).cast("timestamp_ntz"))


def test_scd2_life_of_a_customer(spark):
    check = ["segment", "city"]
    days = [
        people(spark, 1, ("1", "A", None, "n"), ("2", "A", "x", "n")),
        people(spark, 2, ("1", "A", None, "renamed"), ("2", "A", "x", "n")),
        people(spark, 3, ("1", "B", None, "n"), ("2", "A", "x", "n")),
        people(spark, 4, ("1", "B", "y", "n"), ("2", "A", "x", "n")),
        people(spark, 5, ("2", "A", "x", "n")),
        people(spark, 6, ("1", "A", None, "n"), ("2", "A", "x", "n"), ("3", "C", "z", "n")),
    ]
    history = None
    for current in days:
        history = changes.scd2(history, current, "id", check)
        history = materialize(history, "history")
        again = changes.scd2(history, current, "id", check)
        assert sorted(map(repr, again.collect())) == sorted(map(repr, history.collect()))
    found = [
        (r.segment, r.city, r.valid_from.day, r.valid_to and r.valid_to.day)
        for r in history.where("id = '1'").orderBy("valid_from").collect()
    ]
    assert found == [("A", None, 1, 3), ("B", None, 3, 4), ("B", "y", 4, 6), ("A", None, 6, None)]
    assert history.where("id = '2'").count() == 1 and history.where("id = '3'").count() == 1
    opened = history.where("valid_to IS NULL").groupBy("id").count()
    assert opened.where("count <> 1").count() == 0
    assert history.select("scd_id").distinct().count() == history.count()


def test_scd2_closes_missing_keys_on_request(spark):
    history = changes.scd2(None, people(spark, 1, ("1", "A", "x", "n")), "id", ["segment"])
    end = F.lit(dt.datetime(2024, 1, 9)).cast("timestamp_ntz")
    others = people(spark, 9, ("2", "A", "x", "n"))
    closed = changes.scd2(history, others, "id", ["segment"], close_missing_at=end)
    assert closed.where("id = '1'").first().valid_to == dt.datetime(2024, 1, 9)


def test_table_changes(spark, rows):
    old = frame(spark, ("a", 1, 0), ("b", 2, 0), ("c", None, 0))
    new = frame(spark, ("a", 1, 0), ("b", 3, 0), ("c", None, 0), ("d", 4, 0)).where("k <> 'a'")
    assert rows(changes.table_changes(old, new, ["k"]), "_change_type", "k", "v") == [
        ("delete", "a", 1),
        ("insert", "d", 4),
        ("update_post", "b", 3),
        ("update_pre", "b", 2),
    ]


def test_sample_by_key_is_stable_and_close(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    first = {r.k for r in changes.sample_by_key(df, "k", 0.1).collect()}
    second = {r.k for r in changes.sample_by_key(df.repartition(3), "k", 0.1).collect()}
    assert first == second and 1700 < len(first) < 2300


def test_long_list_of_changes_leaves_the_target_in_place(spark, rows, monkeypatch):
    """Whatever hash the filter gives: duplicates and null keys stay as a plain anti join keeps them."""
    monkeypatch.setattr(changes, "MIN_LISTED", 1)
    monkeypatch.setattr(changes, "BITS_PER_KEY", 64)
    key = F.when(F.col("id") % 50 > 0, F.col("id").cast("string"))
    target = materialize(spark.range(2000).union(spark.range(100)).select(key.alias("k"), "id"), "target")
    listed = materialize(spark.range(0, 4000, 40).select(key.alias("k"), F.lit(0).alias("v")), "listed")
    found = changes.unlisted_rows(target, listed, ["k"])
    assert rows(found) == rows(target.join(listed, ["k"], "left_anti"))
    assert len(rows(found)) < target.count()
    candidates = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__bitmap" in candidates and candidates.count("LeftAnti") == 1
    listed_bits = F.pmod(F.xxhash64("k"), F.lit((listed.count() * 64 >> 15) + 1 << 15)).alias("b")
    might_match = target.select("k", listed_bits).join(listed.select(listed_bits).distinct(), "b").count()
    assert might_match < target.count() / 2  # all that the anti join has to move
    numbers = target.select(F.col("id").cast("int").alias("k"))
    other_type = materialize(spark.range(10).withColumnRenamed("id", "k"), "listed")
    assert changes.unlisted_rows(numbers, other_type, ["k"]).count() == 2080


def test_long_list_of_deleted_keys_moves_only_what_it_may_match(spark, rows, monkeypatch):
    key = F.when(F.col("id") % 50 > 0, F.col("id").cast("string"))
    seen = {"is_deleted": F.lit(False), "_updated_at": F.lit(0)}
    target = materialize(spark.range(2000).union(spark.range(100)).select(key.alias("k"), "id").withColumns(seen), "target")
    doomed = spark.range(0, 4000, 40).union(spark.range(0, 400, 40)).select(key.alias("k"))
    want = rows(changes.soft_delete(target, doomed, ["k"], F.lit(9)))
    assert sum(r[2] for r in want) == 42 and len(want) == 2100
    monkeypatch.setattr(changes, "MIN_LISTED", 1)
    monkeypatch.setattr(changes, "BITS_PER_KEY", 64)
    deleted = changes.soft_delete(target, doomed, ["k"], F.lit(9))
    assert rows(deleted) == want and deleted.schema == target.schema
    text = deleted._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in text and "__bitmap" in text


def test_single_keys_stay_where_they_are(spark, rows):
    """Null keys are one key; repeated and equal rows are reduced as the plain way does it."""
    key = F.when(F.col("id") % 97 > 0, (F.col("id") % 1900).cast("string"))
    df = materialize(spark.range(2000).select(key.alias("k"), (F.col("id") % 7).alias("v"), F.lit(1).alias("at")), "source")
    df = df.union(df.where("v = 3"))
    order = [F.desc("at")]
    found = changes.latest_of_repeated(df, ["k"], order)
    assert rows(found) == rows(changes.latest_per_key(df, ["k"], order))
    assert "__bitmap" in found._jdf.queryExecution().optimizedPlan().toString()
    unique = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("at"))
    once = changes.latest_of_repeated(unique, ["k"], order)
    assert once.count() == 100 and "Window" not in once._jdf.queryExecution().optimizedPlan().toString()
    doubles = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "k double, at int")
    assert rows(changes.latest_of_repeated(doubles, ["k"], order), "at") == [(2,)]
