"""Data layout jobs: file compaction, multi-column clustering, column profiles."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.operators.ranks import split_positions
from shopgrain.session import LONGEST_METHOD, setting

GIB = 1024**3
#: Longer methods are never compiled by the JVM, only interpreted.
COMPILED_BYTES = "8000"
#: A distinct sketch of 2**14 registers errs by 0.65 % (one standard deviation); six of them are the bound.
SKETCH_BITS = 14
SKETCH_ERROR = 0.04


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and bytes of every data file below ``path``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = GIB) -> DataFrame:
    """Rewrite many small Parquet files as few of about ``target_bytes``, without a shuffle.

    The scan itself packs small files into splits of that size, one output file per split. The
    settings live in a session of their own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.read.parquet(src).write.parquet(dst)
    return spark.read.parquet(dst)


def morton(positions: list[Column], bits: int) -> Column:
    """Interleave the low ``bits`` bits of the given integers into one BIGINT."""
    step = len(positions)
    spread = [
        F.shiftleft(F.shiftright(p, b).bitwiseAND(1).cast("bigint"), b * step + i)
        for b in range(bits)
        for i, p in enumerate(positions)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), spread)


def zorder(
    df: DataFrame, dst: str, columns: list[str], bits: int = 6, files: int | None = None
) -> DataFrame:
    """Write ``df`` clustered on several columns at once, so filters on any of them skip files.

    Each column is cut into up to 2^bits similar shares, all by one sample that takes one pass; the interleaved share numbers order the
    rows. A row hash after them lets rows that are equal in all columns spread over files.
    """
    spark = df.sparkSession
    parts = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Positions are columns of their own, so each search runs once per row, not once per bit.
    shares = {f"__p{i}": p for i, p in enumerate(split_positions(df, columns, 2**bits))}
    clustered = (
        df.withColumns(shares)
        .withColumn("__z", morton([F.col(p) for p in shares], bits))
        .repartitionByRange(parts, "__z", F.xxhash64(*df.columns))
        .sortWithinPartitions("__z")
        .drop("__z", *shares)
    )
    # The searches of all columns and the hash would be one method too long for the JVM to compile; as steps of their own they aren't.
    with setting(spark, LONGEST_METHOD, COMPILED_BYTES):
        clustered.write.parquet(dst)
    return spark.read.parquet(dst)


def files_for(spark: SparkSession, path: str, target_bytes: int = GIB) -> int:
    total = file_sizes(spark, path).agg(F.sum("length")).first()[0] or 0
    return max(1, math.ceil(total / target_bytes))


def column_statistics(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Rows, nulls, distinct values, minimum and maximum of each column.

    Counts and extremes take one pass. Exact distinct counts run as one group-by per column over that
    column alone, so no row is copied once per column. Estimated ones (``exact=False``) come from mergeable
    sketches of at most 2**SKETCH_BITS bytes a column in that same pass; SKETCH_ERROR bounds nearly all of their errors.
    """
    columns = columns or df.columns
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        text = lambda x: x.cast("string")
        aggregates += [
            F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"),
            text(F.min(c)).alias(f"min_{i}"),
            text(F.max(c)).alias(f"max_{i}"),
        ]
        if not exact:
            sketch = F.hll_sketch_agg(text(F.col(c)), F.lit(SKETCH_BITS))
            aggregates.append(F.hll_sketch_estimate(sketch).alias(f"distinct_{i}"))
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col(f"min_{i}").alias("min_value"),
            F.col(f"max_{i}").alias("max_value"),
            *([] if exact else [F.col(f"distinct_{i}").alias("distinct_count")]),
        )
        for i, c in enumerate(columns)
    ]
    profile = df.agg(*aggregates).select(F.inline(F.array(*lines)))
    if not exact:
        return profile
    distinct = reduce(
        DataFrame.unionByName,
        [
            df.select(c)
            .distinct()
            .agg(F.count(c).alias("distinct_count"))
            .withColumn("column_name", F.lit(c))
            for c in columns
        ],
    )
    return profile.join(distinct, "column_name")
