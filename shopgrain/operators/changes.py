"""Keyed change operators: incremental reads, upsert, soft delete, history, change feed."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions.columns import row_hash
from shopgrain.session import materialize

ROW_NUMBER = "__row_number"
MATCHED = "__matched"
SLOT, BITMAP, HASH = "__slot", "__bitmap", "__hash"
#: Lists of fewer keys are left to Spark, which broadcasts them.
MIN_LISTED = 250_000
#: Bits of the filter for a listed key; a Spark bitmap holds 2**15 bits, at most this many of them (32 MB) are broadcast.
BITS_PER_KEY, BITMAP_SHIFT, MOST_BITMAPS = 16, 15, 8192
#: Types whose equal values always have equal hashes.
HASHED_ALIKE = {"string", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz", "boolean", "binary"}


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``, equal rows told apart by a hash of the row.

    Spark limits each key to one row before the shuffle as well as after it, so many copies of
    one key never meet in a single task.
    """
    window = Window.partitionBy(*keys).orderBy(*order, row_hash(df.columns))
    return (
        df.withColumn(ROW_NUMBER, F.row_number().over(window))
        .where(F.col(ROW_NUMBER) == 1)
        .drop(ROW_NUMBER)
    )


def new_rows(
    source: DataFrame, target: DataFrame | None, ts_col: str, inclusive: bool = False
) -> DataFrame:
    """Source rows past the target's high-water mark; all of them for a missing or empty target.

    ``inclusive`` re-reads the last timestamp, which is safe in front of ``upsert``.
    """
    if target is None:
        return source
    lowest = F.lit("0001-01-01").cast(target.schema[ts_col].dataType)
    # A scalar subquery: known before the scan starts, so files can be skipped by it.
    mark = target.select(F.coalesce(F.max(ts_col), lowest)).scalar()
    return source.where(F.col(ts_col) >= mark if inclusive else F.col(ts_col) > mark)


def latest_of_repeated(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """As ``latest_per_key``, for large tables of mostly single keys, which have to be the same when read again.

    The hashes of all keys are shuffled first; a row whose hash is the only one stays where it is, only the
    others are shuffled whole. The hashes of keys that repeat are written for that.
    """
    if not hashed_alike(df, keys):
        return latest_per_key(df, keys, order)
    hashes = df.select(F.xxhash64(*keys).alias(HASH)).groupBy(HASH).agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(hashes.where("n > 1").select(HASH), "repeated-keys")
    count = repeated.count()
    if not count:
        return df
    single, several = split_by_hash(df, repeated, count, keys)
    return single.unionByName(latest_per_key(several, keys, order))


def hashed_alike(df: DataFrame, keys: list[str]) -> bool:
    return {df.schema[k].dataType.simpleString() for k in keys} <= HASHED_ALIKE


def split_by_hash(df: DataFrame, hashes: DataFrame, count: int, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose key hash is not among ``hashes`` for certain, and all others. The ``count`` hashes are broadcast
    as bitmaps, so no row is moved; ``df`` is read for both."""
    bitmaps = min(MOST_BITMAPS, (count * BITS_PER_KEY >> BITMAP_SHIFT) + 1)

    def slot_of(key_hash: Column) -> Column:
        return F.pmod(key_hash, F.lit(bitmaps << BITMAP_SHIFT))

    def place_of(slot: Column) -> Column:
        return slot.bitwiseAND((1 << BITMAP_SHIFT) - 1)

    slot = slot_of(F.col(HASH))
    bits = hashes.groupBy(F.shiftright(slot, BITMAP_SHIFT).alias(SLOT)).agg(
        F.bitmap_construct_agg(place_of(slot)).alias(BITMAP)
    )
    slot = slot_of(F.xxhash64(*keys))
    place = place_of(slot)
    marked = df.withColumn(SLOT, F.shiftright(slot, BITMAP_SHIFT)).join(F.broadcast(bits), SLOT, "left")
    byte = F.conv(F.hex(F.substring(BITMAP, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1, F.lit(False))
    rest, candidates = (marked.where(c).select(*df.columns) for c in (~is_set, is_set))
    return rest, candidates


def split_by_list(target: DataFrame, listed: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """The target rows whose key is not in ``listed``, a written table, for certain, and all others.

    None for a list that Spark will broadcast anyway, and for keys whose hashes can't be compared.
    """
    if [target.schema[k].dataType for k in keys] != [listed.schema[k].dataType for k in keys] or not hashed_alike(target, keys):
        return None
    count = listed.count()
    if count < MIN_LISTED:
        return None
    return split_by_hash(target, listed.select(F.xxhash64(*keys).alias(HASH)), count, keys)


def unlisted_rows(target: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """The target rows whose key is not in ``listed``, a written table: a left anti join.

    A long list would have the whole target shuffled. Its key hashes are broadcast as bitmaps instead: a row whose bit is not
    set has no match and stays where it is, only the others are shuffled to compare the keys. The target is read for both.
    """
    plain = lambda rows: rows.join(listed.select(*keys), keys, "left_anti")
    parts = split_by_list(target, listed, keys)
    if parts is None:
        return plain(target)
    rest, candidates = parts
    return rest.unionByName(plain(candidates).select(*target.columns))


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    insert: bool = True,
    delete_unmatched: bool = False,
    order: list[Column] | None = None,
    latest: Callable[[DataFrame, list[str], list[Column]], DataFrame] = latest_per_key,
) -> DataFrame:
    """The new image of ``target`` after merging ``source`` by key.

    Matched rows are replaced (or only ``update_cols`` of them), unmatched source rows are
    inserted, and target rows without a source row are kept unless ``delete_unmatched``.
    Several source rows per key are reduced to the first by ``order``, with ``latest``.
    """
    changes = latest(source, keys, order or [])
    if target is None:
        return changes if insert else changes.limit(0)
    # Read twice or more below, so the reduced batch is written once.
    changes = materialize(changes, "change-batch")
    changed_keys = changes.select(*keys)
    parts = []
    if update_cols is not None:
        parts.append(update_columns(target, changes, keys, update_cols, delete_unmatched))
    elif not delete_unmatched:
        parts.append(unlisted_rows(target, changed_keys, keys))
    if update_cols is None and insert:
        parts.append(changes)
    elif update_cols is None:
        parts.append(changes.join(target.select(*keys), keys, "left_semi"))
    elif insert:
        parts.append(changes.join(target.select(*keys), keys, "left_anti"))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.select(*target.columns, *[c for c in merged.columns if c not in target.columns])


def update_columns(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    columns: list[str],
    matched_only: bool = False,
) -> DataFrame:
    """Overwrite ``columns`` of the target rows whose key is in ``source`` (one row per key)."""
    renamed = source.select(
        *keys, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias(MATCHED)
    )
    joined = target.join(renamed, keys, "inner" if matched_only else "left")
    return joined.select(
        *[
            F.when(F.col(MATCHED), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )


def soft_delete(target: DataFrame, doomed: DataFrame, keys: list[str], at: Column) -> DataFrame:
    """Flag the rows whose key is listed in ``doomed``; nothing is removed. A long list moves only rows it may match."""
    listed = materialize(doomed.select(*keys).distinct(), "doomed")
    flags = listed.select(*keys, F.lit(True).alias("is_deleted"), at.alias("_updated_at"))
    rest, candidates = split_by_list(target, listed, keys) or (None, target)
    flagged = update_columns(candidates, flags, keys, ["is_deleted", "_updated_at"])
    return flagged if rest is None else rest.unionByName(flagged)


def scd2(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: list[str],
    updated_at: str = "_updated_at",
    close_missing_at: Column | None = None,
) -> DataFrame:
    """Type 2 history: a new version opens when any of ``check_cols`` differs, nulls included.

    Rerunning with an unchanged ``current`` adds nothing. Keys missing from ``current`` stay
    open unless ``close_missing_at`` says when to close them.
    """
    def opened(prefix: str = "") -> list[Column]:
        at = F.col(f"{prefix}{updated_at}")
        return [
            F.md5(F.concat_ws("|", F.col(f"{prefix}{key}").cast("string"), at.cast("string"))).alias("scd_id"),
            at.alias("valid_from"),
            F.lit(None).cast(current.schema[updated_at].dataType).alias("valid_to"),
        ]

    if history is None:
        return current.select("*", *opened())
    columns = current.columns
    version = [*columns, "scd_id", "valid_from", "valid_to"]
    closed = history.where(F.col("valid_to").isNotNull()).select(*version)
    old = history.where(F.col("valid_to").isNull()).select(
        *[F.col(c).alias(f"old_{c}") for c in version]
    )
    new = current.select(*[F.col(c).alias(f"new_{c}") for c in columns])
    both = old.join(new, F.col(f"old_{key}") == F.col(f"new_{key}"), "full")

    is_old, is_new = F.col(f"old_{key}").isNotNull(), F.col(f"new_{key}").isNotNull()
    same = reduce(
        lambda a, b: a & b, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in check_cols]
    )
    end = (
        F.when(is_new & ~same, F.col(f"new_{updated_at}"))
        .when(~is_new, close_missing_at if close_missing_at is not None else F.lit(None))
    )
    old_row = F.struct(
        *[F.col(f"old_{c}").alias(c) for c in version[:-1]],
        end.cast(current.schema[updated_at].dataType).alias("valid_to"),
    )
    new_row = F.struct(*[F.col(f"new_{c}").alias(c) for c in columns], *opened("new_"))
    rows = F.filter(
        F.array(F.when(is_old, old_row), F.when(is_new & (~is_old | ~same), new_row)),
        lambda r: r.isNotNull(),
    )
    touched = both.select(F.explode(rows).alias("r")).select("r.*")
    return closed.unionByName(touched)


def table_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level change feed between two images of a keyed table.

    One row per insert or delete, and an ``update_pre`` / ``update_post`` pair per update.
    """
    columns = new.columns
    left = old.select(*keys, F.struct(*columns).alias("__old"))
    right = new.select(*keys, F.struct(*columns).alias("__new"))
    both = left.join(right, keys, "full").where(~F.col("__old").eqNullSafe(F.col("__new")))

    def change(kind: Column | str, row: str) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.when(
            F.col(row).isNotNull(), F.struct(kind.alias("_change_type"), F.col(row).alias("row"))
        )

    is_update = F.col("__old").isNotNull() & F.col("__new").isNotNull()
    entries = F.filter(
        F.array(
            change(F.when(is_update, "update_pre").otherwise("delete"), "__old"),
            change(F.when(is_update, "update_post").otherwise("insert"), "__new"),
        ),
        lambda e: e.isNotNull(),
    )
    return both.select(F.explode(entries).alias("e")).select("e.row.*", "e._change_type")


def sample_by_key(df: DataFrame, key: str, fraction: float, seed: str = "") -> DataFrame:
    """Repeatable sample: the key's hash decides, so every run and engine picks the same rows."""
    threshold = format(int(fraction * 16**8), "08x")
    digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    return df.where(F.substring(digest, 1, 8) < threshold)


def cdc_tag(df: DataFrame, operation: Column | str, at: Column) -> DataFrame:
    return df.withColumns({"_cdc_operation": F.lit(operation) if isinstance(operation, str) else operation, "_cdc_timestamp": at})
