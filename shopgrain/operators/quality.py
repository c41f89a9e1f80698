"""Data-quality rules: expectations that drop or warn, and table tests that count failures."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FAILED_RULES = "_failed_rules"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: Literal["drop", "warn"] = "drop"

    def holds(self) -> Column:
        """TRUE or FALSE; an unknown result counts as a violation."""
        return F.coalesce(F.expr(self.predicate).cast("boolean"), F.lit(False))


class Checked(NamedTuple):
    kept: DataFrame
    quarantined: DataFrame
    report: DataFrame


def _all_hold(rules: Iterable[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.holds() for r in rules if r.action == "drop"], F.lit(True))


def broken_rules(rules: Iterable[Rule]) -> Column:
    """The names of the dropping rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules if r.action == "drop"]))


def rule_counts(rules: Iterable[Rule]) -> list[Column]:
    """``total`` and one ``failed_<place>`` per rule, as aggregates."""
    failed = [F.count_if(~r.holds()).alias(f"failed_{i}") for i, r in enumerate(rules)]
    return [F.count(F.lit(1)).alias("total"), *failed]


def rule_lines(rules: Iterable[Rule]) -> Column:
    """The lines of a report from the counts above."""
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            (F.col("total") - F.col(f"failed_{i}")).alias("passed"),
            F.col(f"failed_{i}").alias("failed"),
            (F.col(f"failed_{i}") if r.action == "drop" else F.lit(0).cast("bigint")).alias("dropped"),
        )
        for i, r in enumerate(rules)
    ]
    return F.inline(F.array(*lines))


def kept_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    return df.where(_all_hold(rules))


def quarantined_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """The rows ``kept_rows`` leaves out, with the names of the dropping rules they break."""
    rules = list(rules)
    return df.where(~_all_hold(rules)).withColumn(FAILED_RULES, broken_rules(rules))


def expectation_report(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule, all rules counted in one pass over the data."""
    rules = list(rules)
    return df.agg(*rule_counts(rules)).select(rule_lines(rules))


def apply_expectations(df: DataFrame, rules: Iterable[Rule]) -> Checked:
    rules = list(rules)
    return Checked(kept_rows(df, rules), quarantined_rows(df, rules), expectation_report(df, rules))


# --- table tests: each returns the failing rows, none means the test passes -----------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def failing_rows(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is FALSE; a null value is left to the null test."""
    return df.where(~F.expr(expression))


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


@dataclass(frozen=True)
class TableTest:
    """``kind`` is not_null, unique, expression (a predicate on the column) or range (low, high)."""

    kind: Literal["not_null", "unique", "expression", "range"]
    column: str
    arg: str | tuple[float, float] | None = None

    @property
    def name(self) -> str:
        detail = "" if self.arg is None else f" {self.arg}"
        return f"{self.kind} {self.column}{detail}"

    def violation(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "expression":
            return F.expr(f"NOT ({self.column} {self.arg})")
        low, high = self.arg
        return ~c.between(low, high)


def run_tests(df: DataFrame, tests: Iterable[TableTest], table: str = "") -> DataFrame:
    """Failure count per test. Row-wise tests share one pass; each unique test adds a group-by."""
    tests = list(tests)
    row_wise = [t for t in tests if t.kind != "unique"]
    results = []
    if row_wise:
        counts = df.agg(*[F.count_if(t.violation()).alias(f"f{i}") for i, t in enumerate(row_wise)])
        lines = [
            F.struct(F.lit(t.name).alias("test"), F.col(f"f{i}").alias("failures"))
            for i, t in enumerate(row_wise)
        ]
        results.append(counts.select(F.inline(F.array(*lines))))
    for t in tests:
        if t.kind == "unique":
            results.append(
                duplicate_keys(df, t.column)
                .agg(F.count(F.lit(1)).alias("failures"))
                .select(F.lit(t.name).alias("test"), "failures")
            )
    report = reduce(DataFrame.unionByName, results)
    return report.select(F.lit(table).alias("table_name"), "test", "failures")


def contract_violations(df: DataFrame, contract: StructType, strict: bool = False) -> list[str]:
    """Declared columns that are missing or of another type; metadata only, reads no data."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    problems = []
    for field in contract:
        want, have = field.dataType.simpleString(), actual.get(field.name)
        if have is None:
            problems.append(f"{field.name}: missing")
        elif have != want:
            problems.append(f"{field.name}: expected {want}, found {have}")
    if strict:
        problems += [f"{n}: not declared" for n in actual if n not in contract.fieldNames()]
    return problems


def assert_contract(df: DataFrame, contract: StructType, strict: bool = False) -> DataFrame:
    problems = contract_violations(df, contract, strict)
    if problems:
        raise ValueError("schema contract broken: " + "; ".join(problems))
    return df
