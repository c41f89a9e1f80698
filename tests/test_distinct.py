"""Distinct counts beside sums."""

import pytest
from pyspark.sql import functions as F

from shopgrain.operators.distinct import count_numbers, totals_with_counts
from shopgrain.plans import gold
from shopgrain.sources.conform import Retail


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sold(spark):
    rows = [("a", i % 7, f"p{i % 3}", i) for i in range(100)] + [(None, None, "x", 5), (None, 3, None, None), ("b", None, None, 1)]
    rows += [("c", n, "p", 1) for n in (-40_000, -1, 0, 32_767, 32_768, 32_769, 10**12)] * 2
    return spark.createDataFrame(rows, "g string, n long, p string, v int")


@pytest.mark.parametrize("numbers", [False, True])
def test_counts_equal_the_plain_form(sold, rows, numbers):
    counts = {"ns": "n"} if numbers else {"ns": "n", "ps": "p"}
    got = totals_with_counts(sold, ["g"], [F.sum("v").alias("v"), F.count("*").alias("c")], counts, numbers)
    want = sold.groupBy("g").agg(
        F.sum("v").alias("v"), F.count("*").alias("c"), *[F.count_distinct(c).alias(k) for k, c in counts.items()]
    )
    assert rows(got) == rows(want)
    assert "Expand" not in plan(got)
    assert totals_with_counts(sold.limit(0), ["g"], [F.sum("v").alias("v")], counts, numbers).count() == 0


def test_a_dense_range_moves_as_bits(spark):
    """1e7 numbers of one group, each three times: 306 bitmaps are shuffled."""
    numbers = spark.range(30_000_000).select(F.lit(1).alias("g"), (F.col("id") % 10_000_000).alias("n"))
    assert count_numbers(numbers, ["g"], "n", "c").first().c == 10_000_000


def test_daily_sales_has_no_expand(spark, sf_dir):
    assert "Expand" not in plan(gold.daily_sales(Retail(spark, sf_dir).order_profit))
