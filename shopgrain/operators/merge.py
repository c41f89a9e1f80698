"""Merge by key into a partitioned Parquet table, rewriting only the partitions a change touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.operators.changes import latest_per_key, unlisted_rows
from shopgrain.session import delete_path, materialize


def within(by: str, values: list) -> Column:
    known = F.col(by).isin([v for v in values if v is not None])
    return (known | F.col(by).isNull()) if None in values else known


def read_partitioned(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A partitioned table with the columns and types of ``like``; partition values are not guessed at."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def touched_partitions(target: DataFrame, changes: DataFrame, keys: list[str], by: str) -> list:
    """Values of ``by`` that hold a changed key now or will: at most as many as the table has partitions.

    Of the target only the keys are read; a batch below Spark's broadcast limit leaves them where they are.
    """
    now = target.select(*keys, by).join(changes.select(*keys), keys, "left_semi").select(by)
    return [r[0] for r in now.union(changes.select(by)).distinct().collect()]


def merged_image(target: DataFrame, changes: DataFrame, keys: list[str], by: str, touched: list) -> DataFrame:
    """The touched partitions after the merge. Changed rows leave, the batch comes in; no row of the
    target is shuffled for a batch that can be broadcast, and few are for a larger one."""
    staying = unlisted_rows(target.where(within(by, touched)), changes, keys)
    return staying.unionByName(changes)


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    by: str,
    order: list[Column] | None = None,
    deleted: Column | None = None,
) -> list:
    """Merge ``source`` into the table at ``path``, partitioned by ``by``; returns the partitions rewritten.

    ``source`` has the table's columns; several rows of a key are reduced to the first by ``order``. Rows with a null key
    match nothing. Rows for which ``deleted`` holds only take their key's row away. A changed row may move to another partition. The new partitions are written beside the old ones and
    take their place when all are complete; a merge that failed may simply be run again, as it then
    ends in the same table. A reader that is at work meanwhile may see old and new partitions.
    """
    changes = materialize(latest_per_key(source, keys, order or []), "change-batch")
    target = read_partitioned(spark, path, source)
    touched = touched_partitions(target, changes, keys, by)
    if not touched:
        return []
    image = merged_image(target, changes, keys, by, touched)
    image = materialize(image if deleted is None else image.where(~deleted), "touched")
    left = {r[0] for r in image.select(by).distinct().collect()}
    emptied = [v for v in touched if v not in left]
    if emptied:
        file = F.col("_metadata.file_path")
        rows = spark.read.schema(source.schema).parquet(path).where(within(by, emptied))
        folders = rows.select(F.regexp_extract(file, "^(.*)/[^/]*$", 1)).distinct().collect()
    image.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        by
    ).parquet(path)
    for row in folders if emptied else []:
        delete_path(spark, row[0])
    return touched
