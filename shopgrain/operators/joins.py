"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "__salt"
MIN_SAMPLED = 100


def scan_splits(df: DataFrame) -> int:
    """Input splits of a table scan, known from planning alone; splits are of bounded size."""
    return df.rdd.getNumPartitions()


def hot_keys(
    df: DataFrame, key: str, share: float = 0.005, min_splits: int = 64, sample: float = 0.01
) -> list:
    """Values of ``key`` holding more than ``share`` of the rows: at most ``1 / share`` of them.

    Found on a sample of the one column, and only for tables large enough to matter. The list
    steers how the work is spread, never the result, so a missed or extra key is harmless.
    """
    if scan_splits(df) < min_splits:
        return []
    counts = df.select(key).sample(sample, seed=7).groupBy(key).count()
    top = counts.orderBy(F.desc("count")).limit(int(1 / share)).collect()
    if not top or top[0]["count"] < MIN_SAMPLED:
        return []
    sampled = counts.agg(F.sum("count")).first()[0]
    return [r[key] for r in top if r["count"] > share * sampled]


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "left", hot: list | None = None
) -> DataFrame:
    """Join ``left`` to the keyed table ``right``.

    Without hot keys this is the plain join: Spark broadcasts ``right`` when its size is below
    the configured threshold and shuffles both sides otherwise. Rows of a hot key are spread
    over as many sub-keys as there are shuffle partitions; the few matching rows of ``right``
    are repeated once per sub-key. The salt is the input partition, which a retried task keeps.
    """
    if not hot:
        return left.join(right, key, how)
    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(key).isin([k for k in hot if k is not None])
    if None in hot:
        is_hot = F.col(key).isNull() | is_hot
    salted_left = left.withColumn(
        SALT, F.when(is_hot, F.spark_partition_id() % salts).otherwise(0)
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn(SALT, F.explode(copies))
    return salted_left.join(salted_right, [key, SALT], how).drop(SALT)
