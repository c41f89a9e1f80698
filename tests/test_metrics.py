import datetime as dt

import pytest

from shopgrain.operators.metrics import ORDER_MODEL, query_metrics


@pytest.fixture
def fact(spark):
    d = dt.date
    data = [
        ("1", d(2024, 1, 10), "N", "Completed", 100.0, 40.0),
        ("2", d(2024, 1, 20), "N", "Returned", 50.0, None),
        ("3", d(2024, 2, 5), "N", "Completed", 300.0, 30.0),
        ("4", d(2024, 4, 5), "N", "Completed", 80.0, 8.0),
        ("5", d(2024, 4, 6), "S", "Completed", 0.0, 0.0),
        ("6", d(2024, 5, 6), "S", "Completed", 20.0, 2.0),
    ]
    return spark.createDataFrame(
        data,
        "order_id string, order_date date, region string, status string, net_amount double, "
        "gross_profit double",
    )


def answers(df):
    return {tuple(r)[: len(df.columns) - 1]: tuple(r)[-1] for r in df.collect()}


def test_growth_needs_the_month_before(fact):
    growth = answers(query_metrics(ORDER_MODEL, fact, ["revenue_mom_growth"], ["region"], "month"))
    month = lambda m: dt.date(2024, m, 1)
    assert growth == {
        (month(1), "N"): None,
        (month(2), "N"): 100.0,
        (month(4), "N"): None,  # March is missing: not compared with February
        (month(4), "S"): None,
        (month(5), "S"): None,  # April was zero
    }


def test_growth_looks_before_the_reported_range(fact):
    growth = answers(
        query_metrics(
            ORDER_MODEL, fact, ["revenue_mom_growth"], (), "month", start=dt.date(2024, 2, 1), end=dt.date(2024, 3, 1)
        )
    )
    assert growth == {(dt.date(2024, 2, 1),): 100.0}


def test_mixed_metrics_share_one_pass(fact):
    df = query_metrics(
        ORDER_MODEL,
        fact,
        ["total_revenue", "return_rate", "revenue", "revenue_mom_growth", "gross_profit_margin"],
        grain="month",
        start=dt.date(2024, 1, 1),
    )
    assert df.columns[0] == "period"
    january = df.where("period = '2024-01-01'").first()
    assert january.total_revenue == 100.0 and january.revenue == 150.0
    assert january.return_rate == 0.5 and january.gross_profit_margin == 40.0 / 150.0
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1


def test_entities_and_errors(fact):
    with pytest.raises(KeyError):
        query_metrics(ORDER_MODEL, fact, ["total_orders"], ["no_such"])
    with pytest.raises(KeyError):
        query_metrics(ORDER_MODEL, fact, ["no_such"])
    with pytest.raises(ValueError):
        query_metrics(ORDER_MODEL, fact, ["revenue_mom_growth"])
    assert query_metrics(ORDER_MODEL, fact, ["total_orders"]).first().total_orders == 6


def test_primary_entity_is_counted_without_distinct(fact):
    keyed = fact.withColumn("order_key", fact.order_id)
    asked = dict(metrics=["total_orders", "return_rate"], group_by=["region"])
    plain = query_metrics(ORDER_MODEL, keyed, **asked)
    quick = query_metrics(ORDER_MODEL, keyed, primary_unique=True, **asked)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, quick.collect()))
    assert "Expand" not in quick._jdf.queryExecution().optimizedPlan().toString()
    assert ORDER_MODEL.repeated_primary(keyed).count() == 0
    assert ORDER_MODEL.repeated_primary(keyed.union(keyed)).count() == 6
