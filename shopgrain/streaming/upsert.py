"""Keyed upsert of a change stream into a Parquet table.

The table is split into key buckets. Micro-batch ``n`` writes new images of only the buckets it
touches, below ``version=n``; the image of a bucket is the one in its newest finished version.
Nothing that is being read is overwritten, and replaying a batch rewrites its own version only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopgrain.operators.changes import upsert
from shopgrain.streaming.ingest import AVAILABLE_NOW

BUCKET, VERSION = "bucket", "version"


def _list(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [str(f.getPath()) for f in found or []]


def _part(path: str, name: str) -> int:
    return int(path.split(f"/{name}=")[1].split("/")[0])


def read_current(
    spark: SparkSession,
    table_dir: str,
    before: int | None = None,
    buckets: list[int] | None = None,
) -> DataFrame | None:
    """The table's current image (optionally only some buckets, or as of before a version)."""
    finished = {_part(p, VERSION) for p in _list(spark, f"{table_dir}/{VERSION}=*/_SUCCESS")}
    newest: dict[int, tuple[int, str]] = {}
    for path in _list(spark, f"{table_dir}/{VERSION}=*/{BUCKET}=*"):
        version, bucket = _part(path, VERSION), _part(path, BUCKET)
        if version in finished and (before is None or version < before):
            newest[bucket] = max(newest.get(bucket, (-1, "")), (version, path))
    paths = [p for b, (_, p) in sorted(newest.items()) if buckets is None or b in buckets]
    if not paths:
        return None
    return spark.read.option("basePath", table_dir).parquet(*paths).drop(BUCKET, VERSION)


def write_version(
    changes: DataFrame,
    version: int,
    table_dir: str,
    keys: list[str],
    n_buckets: int,
    order: list[Column] | None = None,
) -> None:
    spark = changes.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")
    touched = [r[0] for r in changes.select(bucket).distinct().collect()]
    if not touched:
        return
    target = read_current(spark, table_dir, before=version, buckets=touched)
    image = upsert(target, changes, keys, order=order).withColumn(BUCKET, bucket)
    (
        image.repartition(BUCKET, F.pmod(F.xxhash64(*image.columns), F.lit(8)))
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(f"{table_dir}/{VERSION}={version}")
    )


def stream_upsert(
    stream: DataFrame,
    table_dir: str,
    keys: list[str],
    checkpoint: str,
    order: list[Column] | None = None,
    n_buckets: int = 64,
    trigger: dict | None = None,
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: write_version(batch, batch_id, table_dir, keys, n_buckets, order)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
