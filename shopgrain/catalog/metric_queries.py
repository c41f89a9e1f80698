"""Questions to the order metric model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.catalog.reference_sql import mean, money, ratio, rnd, with_layers
from shopgrain.catalog.registry import query
from shopgrain.functions import rounded
from shopgrain.operators.metrics import ORDER_MODEL, PERIOD, query_metrics
from shopgrain.sources.conform import Retail

MONTH = "CAST(date_trunc('month', order_date) AS DATE)"
DOUBLES = {
    "revenue",
    "gross_revenue",
    "gross_profit",
    "avg_order_value",
    "total_revenue",
    "gross_profit_margin",
    "revenue_mom_growth",
    "return_rate",
}

REVENUE = f"SUM({money('net_amount')})"
PROFIT = f"SUM({money('gross_profit')})"
SQL = {
    "total_revenue": rnd(f"SUM(CASE WHEN status = 'Completed' THEN {money('net_amount')} END)", 6),
    "gross_profit_margin": rnd(ratio(PROFIT, REVENUE), 6),
    "avg_order_value": rnd(mean("net_amount"), 6),
    "total_orders": "COUNT(DISTINCT order_id)",
    "return_rate": rnd(
        ratio(
            "COUNT(DISTINCT CASE WHEN status = 'Returned' THEN order_id END)",
            "COUNT(DISTINCT order_id)",
        ),
        6,
    ),
    "revenue": rnd(REVENUE, 6),
    "gross_revenue": rnd(f"SUM({money('gross_amount')})", 6),
    "gross_profit": rnd(PROFIT, 6),
    "order_count": "COUNT(DISTINCT order_id)",
    "units_sold": rnd(f"SUM({money('quantity')})", 6),
}


def ask(t: Retail, metrics: list[str], **kwargs) -> DataFrame:
    # Orders are merged by their id, which test_unique checks: one row each.
    answer = query_metrics(ORDER_MODEL, t.order_profit, metrics, primary_unique=True, **kwargs)
    return answer.withColumns(
        {m: rounded(F.col(m), 6) for m in metrics if m in DOUBLES or m == "units_sold"}
    )


def sql(metrics: list[str], keys: dict[str, str], where: str = "TRUE") -> str:
    columns = ", ".join([f"{e} AS {k}" for k, e in keys.items()] + [f"{SQL[m]} AS {m}" for m in metrics])
    groups = " GROUP BY " + ", ".join(str(i + 1) for i in range(len(keys))) if keys else ""
    return with_layers(f"SELECT {columns} FROM fact_orders WHERE {where}{groups}", "fact_orders")


BROAD = ["total_revenue", "gross_profit_margin", "avg_order_value", "total_orders", "return_rate"]
MEASURES = ["revenue", "gross_revenue", "gross_profit", "order_count", "units_sold", "avg_order_value"]


@query(
    "metric_query",
    sql(
        BROAD,
        {PERIOD: MONTH, "region": "region", "discount_tier": "discount_tier"},
        "channel <> '5-LOW' AND order_date >= DATE '1997-01-01' AND order_date < DATE '2000-01-01'",
    ),
)
def metric_query(t: Retail):
    return ask(
        t,
        BROAD,
        group_by=["region", "discount_tier"],
        grain="month",
        where="channel <> '5-LOW'",
        start=dt.date(1997, 1, 1),
        end=dt.date(2000, 1, 1),
    )


@query("metric_measures", sql(MEASURES, {"region": "region", "channel": "channel"}))
def metric_measures(t: Retail):
    return ask(t, MEASURES, group_by=["region", "channel"])


@query("metric_by_customer", sql(["revenue", "order_count"], {"customer": "customer_id"}))
def metric_by_customer(t: Retail):
    return ask(t, ["revenue", "order_count"], group_by=["customer"])


@query("metric_total_revenue", sql(["total_revenue"], {PERIOD: MONTH, "region": "region"}))
def metric_total_revenue(t: Retail):
    return ask(t, ["total_revenue"], group_by=["region"], grain="month")


@query("metric_gross_profit_margin", sql(["gross_profit_margin"], {"discount_tier": "discount_tier"}))
def metric_gross_profit_margin(t: Retail):
    return ask(t, ["gross_profit_margin"], group_by=["discount_tier"])


@query("metric_avg_order_value", sql(["avg_order_value"], {"channel": "channel"}))
def metric_avg_order_value(t: Retail):
    return ask(t, ["avg_order_value"], group_by=["channel"])


@query(
    "metric_total_orders",
    sql(["total_orders"], {PERIOD: "CAST(date_trunc('quarter', order_date) AS DATE)"}),
)
def metric_total_orders(t: Retail):
    return ask(t, ["total_orders"], grain="quarter")


@query("metric_return_rate", sql(["return_rate"], {"region": "region", "channel": "channel"}))
def metric_return_rate(t: Retail):
    return ask(t, ["return_rate"], group_by=["region", "channel"])


@query(
    "metric_revenue_mom_growth",
    with_layers(
        f"""SELECT a.period, a.region,
          {rnd("(a.revenue - b.revenue) / NULLIF(b.revenue, 0) * 100", 6)} AS revenue_mom_growth
        FROM (SELECT {MONTH} AS period, region, CAST({REVENUE} AS DOUBLE) AS revenue FROM fact_orders
              WHERE order_date >= DATE '1996-01-01' GROUP BY 1, 2) a
        LEFT JOIN (SELECT {MONTH} AS period, region, CAST({REVENUE} AS DOUBLE) AS revenue
                   FROM fact_orders GROUP BY 1, 2) b
          ON a.region IS NOT DISTINCT FROM b.region
          AND a.period = CAST(b.period + INTERVAL 1 MONTH AS DATE)""",
        "fact_orders",
    ),
)
def metric_revenue_mom_growth(t: Retail):
    return ask(
        t, ["revenue_mom_growth"], group_by=["region"], grain="month", start=dt.date(1996, 1, 1)
    )
