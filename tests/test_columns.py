"""Edge rows of the scalar rules."""

import datetime as dt
from decimal import Context, Decimal

import pytest
from pyspark.sql import functions as F

from shopgrain.functions import email_mask, money_sum, rounded, surrogate_key, to_bool, to_day
from shopgrain.functions.calendar import us_holiday
from shopgrain.functions.columns import limbs_total, mean_money, money_limbs
from shopgrain.functions.labels import age_band, discount_tier, rfm_segment, stock_status


def evaluate(spark, values, type_name, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [r.out for r in df.withColumn("out", build("v")).orderBy("i").collect()]


def test_email_mask(spark):
    mails = ["john.doe@x.com", "ab@x.com", "a@x.com", "noat", "abc@x.com", "a@b@c.com", None]
    masked = ["jo******@x.com", "ab@x.com", "a@x.com", "noat", "ab*@x.com", "a@*@c.com", None]
    assert evaluate(spark, mails, "string", email_mask) == masked


def test_discount_tiers(spark):
    values = [-0.01, 0.0, 0.0001, 0.10, 0.1001, 0.20, 0.2001, None]
    low, medium, high = "Low (0-10%)", "Medium (10-20%)", "High (20%+)"
    expected = [low, "No Discount", low, low, medium, medium, high, high]
    assert evaluate(spark, values, "double", discount_tier) == expected


def test_age_bands(spark):
    ages = [17, 18, 25, 26, 35, 36, 50, 51, 100, 101, None]
    bands = ["51+", "18-25", "18-25", "26-35", "26-35", "36-50", "36-50", "51+", "51+", "51+", "51+"]
    assert evaluate(spark, ages, "int", age_band) == bands


def test_unreadable_text_becomes_null(spark):
    days = ["2024-02-29", "2024-13-01", "2023-02-29", "", "soon", None]
    assert evaluate(spark, days, "string", to_day) == [dt.date(2024, 2, 29)] + [None] * 5
    flags = ["true", "f", "Yes", "0", "maybe", None]
    assert evaluate(spark, flags, "string", to_bool) == [True, False, True, False, None, None]


def test_rounding_is_half_up_on_decimal_digits(spark):
    assert evaluate(spark, [1.005, 2.675, -1.005], "double", lambda c: rounded(c, 2)) == [
        1.01,
        2.68,
        -1.01,
    ]


def test_surrogate_key_of_null_is_a_key(spark):
    a, b = evaluate(spark, ["1", None], "string", surrogate_key)
    assert a == "c4ca4238a0b923820dcc509a6f75849b" and b is not None and a != b


def test_stock_status_order(spark):
    df = spark.createDataFrame(
        [(True, True), (False, True), (False, False), (None, None)], "o boolean, b boolean"
    )
    out = [r[0] for r in df.select(stock_status("o", "b")).collect()]
    assert out == ["Out of Stock", "Low Stock", "Healthy", "Healthy"]


def test_rfm_segments_over_all_score_triples(spark):
    scores = spark.range(125).select(
        (F.col("id") % 5 + 1).alias("r"),
        (F.floor(F.col("id") / 5) % 5 + 1).alias("f"),
        (F.floor(F.col("id") / 25) + 1).alias("m"),
    )
    counts = scores.groupBy(rfm_segment("r", "f", "m").alias("s")).count().collect()
    assert {r["s"]: r["count"] for r in counts} == {
        "Champions": 8,
        "Loyal Customers": 37,
        "Recent Customers": 20,
        "Frequent Buyers": 20,
        "High Spenders": 16,
        "At Risk": 6,
        "Lost Customers": 12,
        "Potential Loyalists": 6,
    }


@pytest.mark.parametrize(
    "day, name",
    [
        ("2024-01-01", "New Year's Day"),
        ("2024-01-15", "Martin Luther King Jr. Day"),
        ("2024-05-27", "Memorial Day"),
        ("2020-06-19", None),
        ("2024-09-02", "Labor Day"),
        ("2024-11-28", "Thanksgiving"),
        ("2024-12-24", None),
    ],
)
def test_holidays(spark, day, name):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    assert df.select(us_holiday("d")).first()[0] == name


def test_exact_sums_and_means(spark):
    def sums(values, scale=10):
        row = spark.createDataFrame([(v,) for v in values], "v double").agg(
            money_sum("v", scale).alias("s"), mean_money("v", scale).alias("m")
        )
        return row.first()

    third = spark.range(1_000_000).select(money_sum(F.lit(1.0) / 3000).cast("double").alias("s")).first().s
    assert abs(third - 1_000_000 / 3000) < 1e-4
    assert sums([1e15, 0.25, -1e15, 1e17]).s == Decimal("100000000000000000.25")
    assert sums([0.1] * 3).s == Decimal("0.3") and sums([-0.005, -1.5]).s == Decimal("-1.505")
    assert sums([0.12345, 1.0], 2).s == Decimal("1.12")
    assert sums([10.0, 20.0, float("nan"), None]).m == 15.0
    assert sums([1e15 + 0.5] + [1e-7] * 10).s == Decimal("1000000000000000.500001")
    assert sums([1792036.79, 1.01]).s == Decimal("1792037.8")
    empty = sums([None, float("nan")])
    assert empty.s is None and empty.m is None
    for bad in (float("inf"), -float("inf"), 1e18):
        with pytest.raises(Exception, match="out of range"):
            sums([1.0, bad])


def test_sums_of_a_billion_rows(spark):
    """One group of 1e9 rows; then limb sums as 2**43 rows of the largest limbs would leave them."""
    row = spark.range(1_000_000_000).select(money_sum(F.lit(0.9999)).alias("s")).first()
    assert row.s == Decimal("999900000")
    limbs = [F.lit((2**20 - 1) * 2**43).cast("long")] * 3 + [F.lit((2**17 - 1) * 2**43).cast("long")] * 2
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|ARITHMETIC_OVERFLOW"):
        spark.range(1).select(limbs_total(limbs).alias("s")).first()  # 1e31: beyond DECIMAL(38, 10)
    total = spark.range(1).select(limbs_total([F.lit(0), *limbs[1:]]).alias("s")).first().s
    units = 10**10 * 2**43 * (2**40 - 1) + 2**43 * (2**34 - 1)
    wide = Context(prec=60)
    assert total == Decimal(units).scaleb(-10, wide).quantize(Decimal("1e-6"), context=wide)


def test_limb_sums_of_parts_add_up(spark):
    values = [(i % 3, (-1) ** i * (i * 7919.123456 + 10.0**i)) for i in range(17)]
    df = spark.createDataFrame(values, "part int, v double")
    parts = df.groupBy("part").agg(*[F.sum(x).alias(f"l{i}") for i, x in enumerate(money_limbs("v"))])
    total = parts.select(limbs_total([F.sum(f"l{i}") for i in range(5)]).alias("s")).first().s
    assert total == df.select(money_sum("v").alias("s")).first().s
