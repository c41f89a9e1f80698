"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a batch, one after the other, and where each one starts."""
    wide = texts.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, wide.offset * 8)
    data = wide.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def shards(
    batches: Iterator[pa.RecordBatch], limit: int, column: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0)
        offsets = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)])
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
