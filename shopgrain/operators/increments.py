"""Grouped totals and distinct counts kept up to date from changed rows, without reading the whole table again.

Two Parquet tables below one folder, both partitioned: ``totals`` has a row per group with the limb sums of
each amount (they can be subtracted exactly) and the distinct counts; ``support`` has, per group and counted
column, how many rows hold each value, so that a value is known to leave when its last row does.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions.columns import known_value, limbs_total, money_limbs
from shopgrain.operators.merge import merge_partitions, read_partitioned, within
from shopgrain.session import materialize, path_exists

SIGN, ROWS, GROUP, PART = "__sign", "__rows", "__group", "__part"
NAME, VALUE, BEFORE = "__name", "__value", "__before"
LIMBS = 5
ENTRY = [GROUP, NAME, VALUE]


@dataclass(frozen=True)
class Summary:
    """What is kept per group. ``partition`` is an expression over the keys that cuts both tables."""

    keys: list[str]
    partition: str
    money: list[str] = field(default_factory=list)
    integers: list[str] = field(default_factory=list)
    present: list[str] = field(default_factory=list)
    distinct: list[str] = field(default_factory=list)

    def group(self) -> Column:
        """One never-null key, as groups may have null keys."""
        return F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false"})

    def sums(self) -> list[str]:
        return [
            ROWS,
            *[f"{c}__{i}" for c in self.money for i in ["n", *range(LIMBS)]],
            *[f"{c}__{i}" for c in self.integers for i in ("n", "sum")],
            *[f"{c}__n" for c in self.present],
            *[f"{c}__distinct" for c in self.distinct],
        ]

    def columns(self) -> list[str]:
        return [*self.keys, GROUP, PART, *self.sums()]


def signed(pre: DataFrame | None, post: DataFrame) -> DataFrame:
    """Rows that leave count -1, rows that come +1; without ``pre`` all rows come."""
    coming = post.withColumn(SIGN, F.lit(1))
    return coming if pre is None else pre.withColumn(SIGN, F.lit(-1)).unionByName(coming)


def images(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Signed rows of a batch that is merged by key into ``target``: the rows it replaces and its own.

    One row per key on both sides; of the target only rows of changed keys go on.
    """
    replaced = target.join(batch.select(*keys), keys, "left_semi").select(*batch.columns)
    return signed(replaced, batch)


def _total_delta(rows: DataFrame, spec: Summary) -> DataFrame:
    def tally(c: Column) -> Column:
        return F.sum(F.col(SIGN) * c.cast("bigint"))

    sums = [F.sum(SIGN).alias(ROWS)]
    for c in spec.money:
        sums.append(tally(known_value(F.col(c)).isNotNull()).alias(f"{c}__n"))
        sums += [F.coalesce(tally(x), F.lit(0)).alias(f"{c}__{i}") for i, x in enumerate(money_limbs(c))]
    for c in spec.integers:
        sums.append(tally(F.col(c).isNotNull()).alias(f"{c}__n"))
        sums.append(F.coalesce(tally(F.col(c)), F.lit(0)).alias(f"{c}__sum"))
    sums += [tally(F.col(c).isNotNull()).alias(f"{c}__n") for c in spec.present]
    return rows.groupBy(*spec.keys).agg(*sums)


def _support_delta(rows: DataFrame, spec: Summary) -> DataFrame:
    """(keys, name, value, rows): one narrow aggregation per counted column; what cancels out is left out."""
    parts = [
        rows.where(F.col(c).isNotNull())
        .groupBy(*spec.keys, F.lit(c).alias(NAME), F.col(c).cast("string").alias(VALUE))
        .agg(F.sum(SIGN).alias(ROWS))
        .where(f"{ROWS} <> 0")
        for c in spec.distinct
    ]
    return reduce(DataFrame.unionByName, parts)


def _tagged(rows: DataFrame, spec: Summary) -> DataFrame:
    return rows.withColumns({GROUP: spec.group(), PART: F.expr(spec.partition)})


def _distinct_delta(entries: DataFrame, spec: Summary) -> DataFrame:
    """How many values each group gained or lost, a column per counted column."""
    moved = (F.col(ROWS) > 0).cast("bigint") - (F.col(BEFORE) > 0).cast("bigint")
    return entries.groupBy(*spec.keys).agg(
        *[F.coalesce(F.sum(F.when(F.col(NAME) == c, moved)), F.lit(0)).alias(f"{c}__distinct") for c in spec.distinct]
    )


def _held(column: str) -> Column:
    wrong = F.lit("a change takes away rows that the totals do not hold")
    return F.when(F.col(column) < 0, F.raise_error(wrong)).otherwise(F.col(column))


def _add(parts: list[DataFrame], spec: Summary) -> DataFrame:
    """The sum of partial totals or changes by group; a column that a part lacks counts as zero."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    total = merged.groupBy(*spec.keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in spec.sums()])
    return _tagged(total, spec).select(*spec.columns())


def _write(table: DataFrame, root: str, name: str) -> DataFrame:
    """A partitioned table, and an empty one beside it for its schema: a table may lose its last row."""
    table.limit(0).write.parquet(f"{root}/{name}-schema")
    table.write.partitionBy(PART).parquet(f"{root}/{name}")
    return _read(table.sparkSession, root, name)


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_partitioned(spark, f"{root}/{name}", spark.read.parquet(f"{root}/{name}-schema"))


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "totals")


def build(rows: DataFrame, spec: Summary, root: str) -> None:
    """Both tables from all rows; ``rows`` is read once for the totals and once per counted column."""
    coming = signed(None, rows)
    support = _write(_tagged(_support_delta(coming, spec), spec), root, "support")
    counts = _distinct_delta(support.withColumn(BEFORE, F.lit(0)), spec)
    _write(_add([_total_delta(coming, spec), counts], spec), root, "totals")


def of_changed(table: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a state table with a changed key, out of the partitions that hold one (a list no longer than
    the table's own). A value or group never changes its partition."""
    parts = [r[0] for r in changed.select(PART).distinct().collect()]
    return table.where(within(PART, parts)).join(changed.select(*keys), keys, "left_semi").select(*table.columns)


def refresh(spark: SparkSession, root: str, changes: DataFrame, spec: Summary, batch: str) -> DataFrame:
    """Bring both tables up to date with signed rows and return the new totals of the changed groups.

    Only partitions with a changed group are read or rewritten. The new values are staged under the batch's
    name before either table is touched, and merging them twice changes nothing: a run that failed is started
    again with the same ``batch``. Batches go in one after the other. An empty batch changes nothing; a change
    that takes away rows the tables do not hold is an error.
    """
    staged = f"{root}/staged/{batch}"
    if not path_exists(spark, f"{staged}/totals/_SUCCESS"):
        delta = materialize(_tagged(_support_delta(changes, spec), spec), "support-delta")
        old = of_changed(_read(spark, root, "support"), delta, ENTRY)
        both = old.withColumn(BEFORE, F.col(ROWS)).unionByName(delta.withColumn(BEFORE, F.lit(0).cast("bigint")))
        entries = both.groupBy(*spec.keys, *ENTRY, PART).agg(F.sum(ROWS).alias(ROWS), F.sum(BEFORE).alias(BEFORE))
        entries.withColumn(ROWS, _held(ROWS)).write.mode("overwrite").parquet(f"{staged}/support")
        counts = _distinct_delta(spark.read.parquet(f"{staged}/support"), spec)
        moved = materialize(_add([_total_delta(changes, spec), counts], spec), "total-delta")
        groups = of_changed(read_totals(spark, root), moved, [GROUP])
        _add([groups, moved], spec).withColumn(ROWS, _held(ROWS)).write.mode("overwrite").parquet(f"{staged}/totals")
    totals, entries = (spark.read.parquet(f"{staged}/{t}") for t in ("totals", "support"))
    gone = F.col(ROWS) == 0
    merge_partitions(spark, f"{root}/support", entries.drop(BEFORE), ENTRY, PART, deleted=gone)
    merge_partitions(spark, f"{root}/totals", totals, [GROUP], PART, deleted=gone)
    return totals


def money(column: str) -> Column:
    """The exact total of an amount kept in limbs; null if the group has none."""
    total = limbs_total([F.col(f"{column}__{i}") for i in range(LIMBS)])
    return F.when(F.col(f"{column}__n") > 0, total)


def integer(column: str) -> Column:
    return F.when(F.col(f"{column}__n") > 0, F.col(f"{column}__sum"))
