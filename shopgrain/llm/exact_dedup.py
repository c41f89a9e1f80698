"""Exact dedup by content sort, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.common import partitions, text_of
from shopgrain.session import materialize

EDGE_CHARS = 16


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    carry: tuple[str, ...] = (),
    with_text: bool = False,
) -> DataFrame:
    """Group rows whose texts are identical and mark the one that stays.

    Rows are dealt out by sampled splitters over the leading characters and the SHA-256 of the text,
    sorted, and compared with their neighbours over the whole text. A text with more than a quarter
    of a task's fair share of rows is first cut into parts by its ids; the few part results
    are merged afterwards, so no task gathers a whole hot group.

    Returns ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, the carried
    columns and, ``with_text``, the text (empty for null). Null text counts as empty; a null id stays only if the whole group has none; of
    repeated rows (same id and text) one is kept. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pick = F.max if keep == "max" else F.min
    rows = docs.select(
        F.col(id_col).alias("__id"),
        text_of(text_col).alias("__text"),
        *(F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)),
    )
    parts = partitions(spark)
    share = max(docs.count() // (4 * parts), 1000)
    # At most 4 * parts texts can have so many rows: small enough to broadcast at any size.
    hot = (
        rows.groupBy(F.xxhash64("__text").alias("__h"))
        .agg(F.count("*").alias("__n"))
        .where(F.col("__n") > share)
    )
    cut = F.pmod(F.xxhash64(F.col("__id")), F.ceil(F.col("__n") / share)).cast("int")
    ranged = (
        rows.withColumn("__h", F.xxhash64("__text"))
        .join(F.broadcast(hot), "__h", "left")
        .withColumn("__part", F.coalesce(cut, F.lit(-1)))
        .withColumn("__edge", F.substring("__text", 1, EDGE_CHARS))
        .withColumn("__sha", F.sha2("__text", 256))
        .drop("__h", "__n")
        .repartitionByRange("__edge", "__sha", "__part")
    )
    # The range partitioning serves these windows: they sort in place and compare neighbours.
    same = Window.partitionBy("__edge", "__sha", "__part", "__text")
    order = F.desc_nulls_last("__id") if keep == "max" else F.asc_nulls_last("__id")
    runs = materialize(
        ranged.select(
            "__id",
            "__sha",
            "__part",
            *(["__text"] if with_text else []),
            *(f"__c{i}" for i in range(len(carry))),
            F.row_number().over(same.orderBy(order)).alias("__rank"),
            pick("__id").over(same).alias("__keep"),
            F.count("*").over(same).alias("__size"),
        ),
        "content-sort",
    )
    merged = (
        runs.where("__part >= 0 AND __rank = 1")
        .groupBy("__sha")
        .agg(pick("__keep").alias("__all_keep"), F.sum("__size").alias("__all_size"))
    )
    keep_id = F.when(F.col("__part") >= 0, F.col("__all_keep")).otherwise(F.col("__keep"))
    size = F.when(F.col("__part") >= 0, F.col("__all_size")).otherwise(F.col("__size"))
    return runs.join(F.broadcast(merged), "__sha", "left").select(  # bounded as hot is
        F.col("__id").alias(id_col),
        keep_id.alias("keep_id"),
        size.alias("group_size"),
        ((F.col("__rank") == 1) & F.col("__id").eqNullSafe(keep_id)).alias("kept"),
        F.col("__sha").alias("text_sha256"),
        *([F.col("__text").alias(text_col)] if with_text else []),
        *(F.col(f"__c{i}").alias(c) for i, c in enumerate(carry) if c != id_col),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", keep: str = "max") -> DataFrame:
    """The documents that stay, with their own columns; extra columns are kept whatever their name."""
    names = {c: f"__d{i}" for i, c in enumerate(docs.columns)}
    text = names["text"]
    marked = exact_dedup(
        docs.withColumnsRenamed(names).withColumn("__blank", F.col(text).isNull()),
        names[id_col],
        text,
        keep,
        (*(n for n in names.values() if n != text), "__blank"),
        with_text=True,
    )
    own = F.when(~F.col("__blank"), F.col(text))
    return marked.where("kept").select(*((own if n == text else F.col(n)).alias(c) for c, n in names.items()))
