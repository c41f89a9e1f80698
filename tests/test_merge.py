"""Merge into partitions: only touched ones are rewritten, and the target stays where it is."""

import pytest
from pyspark.sql import functions as F

from shopgrain.operators.merge import merge_partitions, merged_image, read_partitioned, touched_partitions
from shopgrain.session import materialize, scratch_path

SCHEMA = "k int, v string, month string, at int"


@pytest.fixture
def table(spark):
    rows = [(i, "old", f"2024-0{i % 4 + 1}", 0) for i in range(40)] + [(None, "old", None, 0), (99, "old", "lone", 0)]
    path = scratch_path(spark, "merge")
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.partitionBy("month").parquet(path)
    return path, rows, df


def files(spark, path):
    rows = spark.read.parquet(path).select("month", F.col("_metadata.file_path").alias("f")).distinct().collect()
    out = {}
    for r in rows:
        out.setdefault(r.month, set()).add(r.f)
    return out


def test_only_touched_partitions_change(spark, table, rows):
    path, old, df = table
    before = files(spark, path)
    batch = [(0, "new", "2024-01", 1), (0, "older", "2024-01", 0), (4, "moved", "2025-01", 1), (100, "added", "2024-02", 1)]
    batch += [(99, "moved", "2024-02", 1), (None, "no key", None, 1)]
    changes = spark.createDataFrame(batch, SCHEMA)
    for _ in range(2):  # a merge that is run again ends in the same table, but for rows without a key
        touched = merge_partitions(spark, path, changes.where("k IS NOT NULL"), ["k"], "month", [F.desc("at")])
    assert set(touched) == {"2024-01", "2024-02", "2025-01"}
    want = {r[0]: r for r in old} | {0: batch[0], 4: batch[2], 100: batch[3], 99: batch[4]}
    assert rows(read_partitioned(spark, path, df)) == sorted(want.values(), key=repr)
    after = files(spark, path)
    assert "lone" not in after
    assert all(after[m] == before[m] for m in (None, "2024-03", "2024-04"))
    merge_partitions(spark, path, changes.where("k IS NULL"), ["k"], "month")
    assert read_partitioned(spark, path, df).where("k IS NULL").count() == 2
    assert merge_partitions(spark, path, changes.limit(0), ["k"], "month") == []


def test_the_target_is_not_shuffled(spark, table):
    path, _, df = table
    changes = materialize(spark.createDataFrame([(1, "new", "2024-02", 1)], SCHEMA), "batch")
    target = read_partitioned(spark, path, df)
    assert touched_partitions(target, changes, ["k"], "month") == ["2024-02"]
    plan = merged_image(target, changes, ["k"], "month", ["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "partitioning(" not in plan  # no exchange but the batch's broadcast
    assert "month#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
