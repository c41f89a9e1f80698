"""Places of rows in an order, without moving a group through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.session import materialize

ROW_BITS = 33  # of monotonically_increasing_id: the bits above them number the task


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``, the place (from 0) of each row in its group, nulls first.

    Rows are dealt out by sampled ranges of the order, sorted and written once with their place in
    their task; the tasks' counts by group tell how many rows stand before. Rows alike in ``order`` may
    be told apart by the split they were read from, so even a hot value spreads over several tasks;
    their places among each other carry no meaning.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = materialize(
        rows.withColumn("__split", F.spark_partition_id())
        .repartitionByRange(*keys, "__split")
        .sortWithinPartitions(*keys)
        .drop("__split")
        .withColumn("__at", F.monotonically_increasing_id()),
        "places",
    ).withColumn("__task", F.shiftright("__at", ROW_BITS))
    before = Window.partitionBy("__group").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy(F.col("__task").alias("__of"), F.col(group).alias("__group"))
        .agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    )
    found = placed.join(
        runs, (F.col("__task") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group"))
    )
    place = F.col("__before") + F.col("__at") - F.col("__first")
    return found.select(*rows.columns, place.alias(name))
