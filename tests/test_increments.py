"""Totals kept from changes equal totals of all rows, and only what changed is read again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import increments
from shopgrain.operators.increments import Summary
from shopgrain.session import materialize, scratch_path

SCHEMA = "id int, day date, shop string, amount double, units int, buyer string"
SPEC = Summary(["day", "shop"], "date_format(day, 'yyyy-MM')", ["amount"], ["units"], ["id"], ["buyer"])


def data():
    days = [dt.date(2024, 1 + i % 4, 1 + i % 3) for i in range(60)]
    rows = [
        (i, days[i] if i % 13 else None, f"s{i % 2}" if i % 7 else None, None if i % 11 == 0 else i * 0.1, i % 5, f"b{i % 6}")
        for i in range(60)
    ]
    return [*rows, (60, dt.date(2024, 6, 1), "lone", float("nan"), None, None)]


def report(totals):
    return totals.where("__rows > 0").select(
        "day", "shop", "__rows", "id__n", "buyer__distinct",
        increments.money("amount").alias("amount"), increments.integer("units").alias("units"),
    )


def direct(df):
    known = F.when(~F.isnan("amount"), F.col("amount"))
    return df.groupBy("day", "shop").agg(
        F.count("*").alias("__rows"), F.count("id").alias("id__n"), F.count_distinct("buyer").alias("buyer__distinct"),
        F.sum(known.cast("decimal(20,10)")).cast("decimal(38,10)").alias("amount"), F.sum("units").alias("units"),
    )


@pytest.fixture
def state(spark):
    root = scratch_path(spark, "increments")
    increments.build(spark.createDataFrame(data(), SCHEMA), SPEC, root)
    return root


def files(spark, root, table):
    read = spark.read.parquet(f"{root}/{table}").select("__part", F.col("_metadata.file_path").alias("f"))
    out = {}
    for r in read.distinct().collect():
        out.setdefault(r[0], set()).add(r.f)
    return out


def test_refresh_equals_a_full_run(spark, state, rows):
    old = {r[0]: r for r in data()}
    df = spark.createDataFrame(data(), SCHEMA)
    assert rows(report(increments.read_totals(spark, state))) == rows(direct(df))
    day = dt.date(2024, 2, 2)
    batch = [(1, day, "s1", 7.25, 3, "b9"), (2, day, None, None, None, None), (100, day, "s0", 1e9, 1, "b0")]
    batch += [(60, day, "s0", 2.5, 2, "b1")]  # the only row of its group, and of its month, moves
    post = spark.createDataFrame(batch, SCHEMA)
    want = spark.createDataFrame(list((old | {r[0]: r for r in batch}).values()), SCHEMA)
    before = {t: files(spark, state, t) for t in ("totals", "support")}
    for _ in range(2):  # the same batch again changes nothing
        increments.refresh(spark, state, increments.images(df, post, ["id"]), SPEC, "b1")
        assert rows(report(increments.read_totals(spark, state))) == rows(direct(want))
    for t, was in before.items():
        now = files(spark, state, t)
        touched = {m for m in was if now.get(m) != was[m]}
        assert touched <= {"2024-02", "2024-03", "2024-06"} and "2024-06" not in now
    # All of it taken away again: no group, no support is left.
    increments.refresh(spark, state, want.withColumn(increments.SIGN, F.lit(-1)), SPEC, "b2")
    assert increments.read_totals(spark, state).count() == 0


def test_an_empty_batch_and_a_wrong_one(spark, state, rows):
    df = spark.createDataFrame(data(), SCHEMA)
    increments.refresh(spark, state, increments.signed(None, df.limit(0)), SPEC, "none")
    assert rows(report(increments.read_totals(spark, state))) == rows(direct(df))
    stranger = df.where("id = 5").withColumns({"shop": F.lit("never seen"), increments.SIGN: F.lit(-1)})
    with pytest.raises(Exception, match="do not hold"):
        increments.refresh(spark, state, stranger, SPEC, "wrong")
    assert rows(report(increments.read_totals(spark, state))) == rows(direct(df))


def test_only_changed_partitions_are_read(spark, state):
    totals = increments.read_totals(spark, state)
    changed = materialize(totals.where("__part = '2024-03'").select("__group", "__part"), "changed")
    plan = increments.of_changed(totals, changed, ["__group"])._jdf.queryExecution().executedPlan().toString()
    assert "2024-03" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "BroadcastHashJoin" in plan and "partitioning(" not in plan
