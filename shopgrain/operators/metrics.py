"""Metric layer: measures and metrics declared once, answered as one DataFrame aggregation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import money_sum, ratio
from shopgrain.functions.columns import SUM_SCALE, mean_money

PERIOD = "period"
REPORTED = "__reported"


@dataclass(frozen=True)
class Entity:
    """A key of the fact. ``primary``: one row per value; ``id_column`` counts the same things."""

    expr: str
    kind: Literal["primary", "foreign"] = "foreign"
    id_column: str | None = None


@dataclass(frozen=True)
class Measure:
    name: str
    agg: Literal["sum", "average", "count_distinct"]
    expr: str
    #: Decimals that sums and averages keep of each value.
    scale: int = SUM_SCALE

    def aggregate(self, where: str | None, unique: bool = False) -> Column:
        value = F.expr(self.expr)
        if where:
            value = F.when(F.expr(where), value)
        if self.agg == "count_distinct":
            return F.count(value) if unique else F.count_distinct(value)
        if self.agg == "sum":
            return money_sum(value, self.scale).cast("double")
        return mean_money(value, self.scale)


@dataclass(frozen=True)
class Input:
    """A metric or measure used inside another metric, possibly filtered or of an earlier month."""

    name: str
    alias: str | None = None
    where: str | None = None
    offset_months: int = 0


@dataclass(frozen=True)
class Metric:
    """``simple``: one input; ``ratio``: two; ``derived``: ``compute`` over the inputs by alias."""

    name: str
    kind: Literal["simple", "ratio", "derived"]
    inputs: tuple[Input, ...]
    label: str = ""
    compute: Callable[[dict[str, Column]], Column] | None = None


@dataclass(frozen=True)
class MetricModel:
    time_dimension: str
    dimensions: tuple[str, ...]
    entities: dict[str, Entity]
    measures: tuple[Measure, ...]
    metrics: tuple[Metric, ...] = field(default=())

    def metric(self, name: str) -> Metric:
        """A metric by name; a bare measure name stands for the simple metric over it."""
        for m in self.metrics:
            if m.name == name:
                return m
        self.measure(name)
        return Metric(name, "simple", (Input(name),))

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(f"no metric or measure named {name!r}")

    def counts_primary(self, measure: Measure) -> bool:
        """Whether the measure counts the primary entity, of which each fact row has its own."""
        ids = [x for e in self.entities.values() if e.kind == "primary" for x in (e.expr, e.id_column)]
        return measure.agg == "count_distinct" and measure.expr in ids

    def repeated_primary(self, fact: DataFrame) -> DataFrame:
        """Values of the primary entity on more than one row of the fact; none, if it is one."""
        keys = [F.expr(e.expr).alias("entity") for e in self.entities.values() if e.kind == "primary"]
        rows = fact.select(*keys).where("entity IS NOT NULL")
        return rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")

    def is_measure(self, name: str) -> bool:
        return any(m.name == name for m in self.measures)


def _both(a: str | None, b: str | None) -> str | None:
    return f"({a}) AND ({b})" if a and b else a or b


def _plain(model: MetricModel, item: Input, unique: bool) -> Column | None:
    """The input as one aggregate column, or None when it needs a derived metric."""
    if model.is_measure(item.name):
        measure = model.measure(item.name)
        return measure.aggregate(item.where, unique and model.counts_primary(measure))
    metric = model.metric(item.name)
    if metric.kind == "derived":
        return None
    inputs = [
        _plain(model, Input(i.name, where=_both(i.where, item.where)), unique) for i in metric.inputs
    ]
    if any(c is None for c in inputs):
        return None
    return inputs[0] if metric.kind == "simple" else ratio(inputs[0], inputs[1])


def query_metrics(
    model: MetricModel,
    fact: DataFrame,
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    grain: str | None = None,
    where: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    primary_unique: bool = False,
) -> DataFrame:
    """Metrics per (period, dimensions); ``start`` and ``end`` bound the reported days, end excluded.

    All metrics share one pass over the fact, whatever their filters and time offsets. An input
    of an earlier month is aggregated over the days moved back by its offset, and the small
    per-period result is then moved forward to the period it is compared with: a missing month
    gives null rather than the month before it.

    ``primary_unique``: the caller's table keeps one row per primary entity, as a merge by its key
    does and ``repeated_primary`` checks; its distinct count is then a plain count.
    """
    for name in group_by:
        if name not in model.dimensions and name not in model.entities:
            raise KeyError(f"unknown dimension {name!r}")
    wanted = [model.metric(m) for m in metrics]
    derived = [m for m in wanted if m.kind == "derived"]
    offsets = sorted({0} | {i.offset_months for m in derived for i in m.inputs})
    if offsets != [0] and not grain:
        raise ValueError("comparing periods needs a time grain")

    keys = [PERIOD, *group_by] if grain else list(group_by)
    day = model.time_dimension
    rows = fact.where(where) if where else fact
    in_range = {o: _day_range(day, start, end, o) for o in offsets}
    if all(in_range.values()):
        rows = rows.where(" OR ".join(f"({r})" for r in in_range.values()))
    grouping = [
        F.expr(model.entities[g].expr if g in model.entities else g).alias(g) for g in group_by
    ]
    if grain:
        grouping.insert(0, F.to_date(F.date_trunc(grain, F.col(day))).alias(PERIOD))

    columns: dict[int, dict[str, Column]] = {o: {} for o in offsets}

    def add(name: str, item: Input) -> None:
        # One offset: the row filter above has done the day range already.
        days = in_range[item.offset_months] if len(offsets) > 1 else None
        column = _plain(model, Input(item.name, where=_both(item.where, days)), primary_unique)
        if column is None:
            raise ValueError(f"{item.name} is itself derived")
        columns[item.offset_months][name] = column

    for m in wanted:
        if m.kind != "derived":
            add(m.name, Input(m.name))
    for m in derived:
        for i in m.inputs:
            add(_input_name(m, i), i)
    if len(offsets) > 1 and in_range[0]:
        columns[0][REPORTED] = F.count_if(F.expr(in_range[0])) > 0
    elif len(offsets) > 1:
        columns[0][REPORTED] = F.lit(True)

    flat = {name: c for per_offset in columns.values() for name, c in per_offset.items()}
    totals = rows.groupBy(*grouping).agg(*[c.alias(name) for name, c in flat.items()])
    if len(offsets) > 1:
        totals = _align(totals, keys, {o: list(c) for o, c in columns.items()})
    answers = {
        m.name: m.compute({i.alias or i.name: F.col(_input_name(m, i)) for i in m.inputs})
        if m.kind == "derived"
        else F.col(m.name)
        for m in wanted
    }
    return totals.select(*keys, *[c.alias(name) for name, c in answers.items()])


def _input_name(metric: Metric, item: Input) -> str:
    return f"__{metric.name}__{item.alias or item.name}"


def _day_range(day: str, start: dt.date | None, end: dt.date | None, months_back: int) -> str:
    def bound(d: dt.date) -> str:
        return f"add_months(DATE '{d.isoformat()}', {-months_back})"

    parts = [f"{day} >= {bound(start)}"] if start else []
    parts += [f"{day} < {bound(end)}"] if end else []
    return " AND ".join(parts)


def _align(totals: DataFrame, keys: list[str], columns: dict[int, list[str]]) -> DataFrame:
    """Bring the columns of each offset to the period they belong to; one row per reported period."""
    names = [name for per_offset in columns.values() for name in per_offset]
    others = [k for k in keys if k != PERIOD]
    moved = [
        F.struct(
            F.add_months(PERIOD, offset).alias(PERIOD),
            *[
                (F.col(n) if n in mine else F.lit(None).cast(totals.schema[n].dataType)).alias(n)
                for n in names
            ],
        )
        for offset, mine in columns.items()
    ]
    spread = totals.select(*others, F.inline(F.array(*moved)))
    # Each column has one non-null row per key, so max only picks it.
    picked = spread.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])
    return picked.where(REPORTED).drop(REPORTED)


# Names, expressions and filters of the order model.
ORDER_MODEL = MetricModel(
    time_dimension="order_date",
    dimensions=("region", "channel", "status", "discount_tier"),
    entities={
        "order": Entity("order_key", "primary", id_column="order_id"),
        "customer": Entity("customer_id"),
        "product": Entity("product_id"),
    },
    measures=(
        Measure("revenue", "sum", "net_amount"),
        Measure("gross_revenue", "sum", "gross_amount"),
        Measure("gross_profit", "sum", "gross_profit"),
        Measure("order_count", "count_distinct", "order_id"),
        Measure("units_sold", "sum", "quantity"),
        Measure("avg_order_value", "average", "net_amount"),
    ),
    metrics=(
        Metric(
            "total_revenue",
            "simple",
            (Input("revenue", where="status = 'Completed'"),),
            label="Total Revenue",
        ),
        Metric(
            "gross_profit_margin",
            "ratio",
            (Input("gross_profit"), Input("revenue")),
            label="Gross Profit Margin %",
        ),
        Metric(
            "avg_order_value", "simple", (Input("avg_order_value"),), label="Average Order Value"
        ),
        Metric("total_orders", "simple", (Input("order_count"),), label="Total Orders"),
        Metric(
            "revenue_mom_growth",
            "derived",
            (Input("revenue"), Input("revenue", alias="lag_revenue", offset_months=1)),
            label="Revenue Month-over-Month Growth %",
            compute=lambda m: ratio(m["revenue"] - m["lag_revenue"], m["lag_revenue"]) * 100,
        ),
        Metric(
            "return_rate",
            "ratio",
            (Input("order_count", where="status = 'Returned'"), Input("order_count")),
            label="Return Rate %",
        ),
    ),
)
