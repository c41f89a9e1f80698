"""Cleaning of dirty raw rows."""

from pyspark.sql import functions as F

from shopgrain.operators import quality
from shopgrain.plans import gold, silver, star


def stamp():
    return F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")

RAW = (
    "order_id string, customer_id string, product_id string, quantity string, unit_price string, "
    "discount_pct string, gross_amount string, net_amount string, order_date string, "
    "channel string, region string, status string, ship_days string, _ingested_at timestamp_ntz"
)


def order(spark, *changes):
    base = dict(
        order_id="o", customer_id="c", product_id="p", quantity="2", unit_price="5",
        discount_pct="0.1", gross_amount="10", net_amount="9", order_date="2024-01-05",
        channel="web", region="North", status="Completed", ship_days="1", _ingested_at=None,
    )
    names = [part.split()[0] for part in RAW.split(",")]
    return spark.createDataFrame([[{**base, **c}[n] for n in names] for c in changes], RAW)


def test_bad_measures_are_dropped_not_fatal(spark):
    raw = order(
        spark,
        {"order_id": "good"},
        {"order_id": None},
        {"quantity": "0"},
        {"quantity": "-1"},
        {"quantity": "abc"},
        {"quantity": None},
        {"net_amount": "0"},
        {"net_amount": "-5"},
        {"net_amount": None},
    )
    assert [r.order_id for r in silver.silver_orders(raw, stamp()).collect()] == ["good"]


def test_bad_dates_survive_as_null(spark):
    raw = order(spark, {"order_id": "a", "order_date": "2024-13-01"}, {"order_id": "b"})
    years = {r.order_id: r.order_year for r in silver.silver_orders(raw, stamp()).collect()}
    assert years == {"a": None, "b": 2024}


def test_full_name_rules_differ(spark):
    people = spark.createDataFrame(
        [("1", "a", None), ("2", None, "b"), ("3", "a", "b")],
        "customer_id string, first_name string, last_name string",
    ).withColumns(
        {c: F.lit(None).cast("string") for c in ("email", "city", "state", "segment", "join_date", "is_active")}
    ).withColumns({"age": F.lit(30), "_ingested_at": stamp()})
    strict = silver.silver_customers(people, F.current_date(), stamp())
    loose = silver.expect_customers(people)
    assert {r.customer_id: r.full_name for r in strict.collect()} == {"1": None, "2": None, "3": "a b"}
    assert {r.customer_id: r.full_name for r in loose.collect()} == {"1": "a", "2": "b", "3": "a b"}


def test_dedup_comes_before_expectations(spark):
    raw = order(
        spark, {"order_id": "x", "quantity": "1"}, {"order_id": "x", "quantity": "0"}
    ).withColumn("_ingested_at", F.when(F.col("quantity") == "0", stamp() + F.expr("INTERVAL 1 DAY")).otherwise(stamp()))
    raw = raw.withColumn("quantity", F.col("quantity").cast("int"))
    kept = quality.kept_rows(silver.expect_orders(raw, stamp()), silver.ORDER_RULES)
    assert kept.count() == 0


def test_unknown_product_keeps_the_order_without_profit(spark):
    orders = silver.silver_orders(order(spark, {"order_id": "a"}, {"order_id": "b", "product_id": "?"}), stamp())
    customers = spark.createDataFrame([("c", "k")], "customer_id string, customer_key string")
    products = spark.createDataFrame([("p", "pk", 1.5)], "product_id string, product_key string, cost_price double")
    fact = star.fact_orders(orders, customers, products)
    assert {r.order_id: (r.product_key, r.gross_profit) for r in fact.collect()} == {
        "a": ("pk", 6.0),
        "b": (None, None),
    }
    totals = gold.daily_sales(fact).first()
    assert (totals.total_orders, totals.total_gross_profit, totals.avg_margin_pct) == (2, 6.0, 66.67)


def test_fact_lookups_move_only_what_the_rest_follows_from(spark, sf_dir):
    from shopgrain.sources.conform import Retail

    t = Retail(spark, sf_dir)
    fact = star.fact_orders(t.silver_orders, t.dim_customer, t.dim_product, rebalance_by="order_month_key")
    assert fact.columns == star.FACT_COLUMNS
    plan = fact._jdf.queryExecution().optimizedPlan()
    last = plan.toString().split("RebalancePartitions", 1)
    assert len(last) == 2 and "discount_tier" in last[0]
    assert not any(c in last[1] for c in ("AS discount_tier", "AS order_key", "AS is_returned", "AS order_year"))


def test_large_customer_dimension_is_asked_for_the_ids_it_lacks(spark, rows, monkeypatch):
    """No line is moved for the customer key, and no key on the way; the fact is as a join makes it."""
    ids = ("1", "1", "2", "3", None, "x")
    lines = [{"order_id": str(i), "customer_id": c, "product_id": "pq"[i % 2]} for i, c in enumerate(ids)]
    orders = silver.silver_orders(order(spark, *lines), stamp())
    people = spark.createDataFrame([("1",), ("2",), ("4",), (None,)], "customer_id string")
    customers = people.withColumn("customer_key", star.surrogate_key("customer_id"))
    goods = spark.createDataFrame([("p", 1.5)], "product_id string, cost_price double")
    products = goods.withColumn("product_key", star.surrogate_key("product_id"))

    def joins(fact):
        return fact._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    plain = star.fact_orders(orders, customers, products)
    want = {(r.order_id, r.customer_key is not None, r.product_key is not None) for r in plain.collect()}
    assert want == {(str(i), c in ("1", "2"), i % 2 == 0) for i, c in enumerate(ids)}
    twice = customers.union(customers)
    custom = customers.withColumn("customer_key", F.concat(F.lit("k"), "customer_id"))
    wanted = [rows(star.fact_orders(orders, c, products)) for c in (customers, twice, custom)]
    assert len(wanted[1]) == 9 and joins(plain) == 2
    monkeypatch.setattr(star, "MIN_LOOKED_UP", 0)
    for c, w in zip((customers, twice, custom), wanted, strict=True):
        assert rows(star.fact_orders(orders, c, products)) == w
    asked = star.fact_orders(orders, customers, products, customer_ids=orders.select("customer_id").union(people))
    assert rows(asked) == wanted[0]
    everyone = orders.select("customer_id").distinct()
    all_known = everyone.withColumn("customer_key", star.surrogate_key("customer_id"))
    fact = star.fact_orders(orders, all_known, products, rebalance_by="order_month_key")
    assert joins(fact) == 1 and fact.where("customer_key IS NULL").count() == 1
    moved = fact._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions", 1)[1]
    assert "md5" not in moved
    monkeypatch.setattr(star, "MOST_MISSING", 0)
    assert rows(star.fact_orders(orders, customers, products)) == wanted[0]


def test_sales_totals_agree_with_the_fact(spark, sf_dir):
    from shopgrain.sources.conform import Retail

    t = Retail(spark, sf_dir)
    fact = t.order_profit.select(F.sum(F.col("net_amount").cast("decimal(18,4)"))).first()[0]
    # Each group rounds to cents.
    sales = gold.daily_sales(t.order_profit)
    total, groups = sales.select(F.sum(F.col("total_revenue").cast("decimal(18,4)")), F.count("*")).first()
    assert abs(float(fact) - float(total)) <= 0.005 * groups
    unique = gold.daily_sales(t.order_profit, orders_unique=True)
    assert sales.exceptAll(unique).count() == 0
