"""Expectations and table tests over the conformed feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.catalog.reference_sql import with_layers
from shopgrain.catalog.registry import query
from shopgrain.operators import quality
from shopgrain.operators.quality import Rule, TableTest
from shopgrain.plans import gold, silver
from shopgrain.plans.declared import ORDER_CONTRACT, SILVER_TESTS, SOURCE_TESTS
from shopgrain.session import materialize
from shopgrain.sources import schemas
from shopgrain.sources.conform import Retail

# The conformed inventory holds empty shelves, so these rules find violations.
STOCK_RULES = (
    Rule("in_stock", "quantity_on_hand > 0", "drop"),
    Rule("closed_period", "snapshot_date < '2001-01-01'", "drop"),
    Rule("above_reorder", "quantity_on_hand >= reorder_level", "warn"),
    Rule("recent", "snapshot_date >= '1998-01-01'", "warn"),
)
IN_STOCK = "COALESCE(quantity_on_hand > 0, FALSE)"
CLOSED = "COALESCE(snapshot_date < '2001-01-01', FALSE)"
ABOVE = "COALESCE(quantity_on_hand >= reorder_level, FALSE)"
RECENT = "COALESCE(snapshot_date >= '1998-01-01', FALSE)"


@query(
    "expect_or_drop",
    with_layers(
        f"SELECT inventory_id, quantity_on_hand FROM bronze_inventory WHERE {IN_STOCK} AND {CLOSED}",
        "bronze_inventory",
    ),
)
def expect_or_drop(t: Retail):
    return quality.kept_rows(t.bronze_inventory, STOCK_RULES).select(
        "inventory_id", "quantity_on_hand"
    )


#: Broken values put into rows picked by the first letters of their key's hash: (letters, column,
#: value). The source tables are clean; without these no declared rule could fail.
BROKEN = {
    "orders": (
        ("0a", "quantity", "0"),
        ("1b", "net_amount", "-1.0"),
        ("2c", "order_date", "'2024-13-01'"),
        ("3d", "discount_pct", "1.5"),
        ("4e", "order_id", "NULL"),
    ),
    "customers": (("0", "age", "17"), ("1", "email", "'nobody'"), ("2", "customer_id", "NULL")),
    "products": (("0a", "cost_price", "0.0"), ("1b", "retail_price", "-1.0"), ("2c", "product_id", "NULL")),
    "inventory": (("0a", "quantity_on_hand", "-1"), ("1b", "inventory_id", "NULL")),
}
DECLARED = {
    "orders": (silver.ORDER_RULES, lambda t, rows: silver.expect_orders(rows, t.batch_ts)),
    "customers": (silver.CUSTOMER_RULES, lambda t, rows: silver.expect_customers(rows)),
    "products": (silver.PRODUCT_RULES, lambda t, rows: silver.expect_products(rows)),
    "inventory": (silver.INVENTORY_RULES, lambda t, rows: silver.expect_inventory(rows)),
}


def picked(feed: str, letters: str) -> str:
    return f"substr(md5({schemas.KEYS[feed]}), 1, {len(letters)}) = '{letters}'"


def broken_feed(t: Retail, feed: str) -> DataFrame:
    rows = t.bronze(feed)
    return rows.withColumns(
        {c: F.expr(f"CASE WHEN {picked(feed, x)} THEN {v} ELSE {c} END") for x, c, v in BROKEN[feed]}
    )


def declared_sql(only: str | None, line) -> str:
    """Counts from the predicates told again for the broken rows: all null keys are one row."""
    parts = []
    for feed, (rules, _) in DECLARED.items():
        key = schemas.KEYS[feed]
        by_column = {c: picked(feed, x) for x, c, _ in BROKEN[feed]}
        null_key = by_column[key]
        total = f"(count(*) FILTER (NOT {null_key}) + max(({null_key})::INT))::BIGINT"
        for rule in rules:
            if only in (None, rule.action):
                column = next(c for c in by_column if c in rule.predicate)
                failed = f"max(({null_key})::INT)" if column == key else f"count(*) FILTER ({by_column[column]})"
                parts.append(line(rule, f"({failed})::BIGINT", total) + f" FROM bronze_{feed}")
    return with_layers(" UNION ALL ".join(parts), *(f"bronze_{f}" for f in DECLARED))


def declared_report(t: Retail, action: str | None = None) -> DataFrame:
    """The declared rules of all four tables, counted on feeds with broken rows."""
    reports = [
        quality.expectation_report(
            clean(t, broken_feed(t, feed)), [r for r in rules if action in (None, r.action)]
        )
        for feed, (rules, clean) in DECLARED.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query("expect_warn", declared_sql("warn", lambda r, failed, n: f"SELECT '{r.name}' AS rule, {failed} AS failed"))
def expect_warn(t: Retail):
    return declared_report(t, "warn").select("rule", "failed")


@query(
    "expectation_report",
    declared_sql(
        None,
        lambda r, failed, n: f"SELECT '{r.name}' AS rule, '{r.action}' AS action, {n} - {failed} AS passed, "
        f"{failed} AS failed, {failed if r.action == 'drop' else '0::BIGINT'} AS dropped",
    ),
)
def expectation_report(t: Retail):
    return declared_report(t)


@query(
    "quarantine_rows",
    with_layers(
        f"""SELECT inventory_id, concat_ws(',', CASE WHEN NOT {IN_STOCK} THEN 'in_stock' END,
          CASE WHEN NOT {CLOSED} THEN 'closed_period' END) AS broken_rules
        FROM bronze_inventory WHERE NOT ({IN_STOCK} AND {CLOSED})""",
        "bronze_inventory",
    ),
)
def quarantine_rows(t: Retail):
    rows = quality.quarantined_rows(t.bronze_inventory, STOCK_RULES)
    return rows.select(
        "inventory_id", F.concat_ws(",", quality.FAILED_RULES).alias("broken_rules")
    )


@query(
    "test_not_null",
    "SELECT c_custkey FROM customer LEFT JOIN "
    "(SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey "
    "WHERE o_custkey IS NULL",
)
def test_not_null(t: Retail):
    partial = t.table("orders").where("o_orderstatus = 'P'").select("o_custkey").distinct()
    joined = t.table("customer").join(partial, F.col("c_custkey") == F.col("o_custkey"), "left")
    return quality.null_rows(joined, "o_custkey").select("c_custkey")


@query(
    "test_unique",
    "SELECT l_orderkey, COUNT(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL "
    "GROUP BY 1 HAVING COUNT(*) > 1",
)
def test_unique(t: Retail):
    return quality.duplicate_keys(t.table("lineitem"), "l_orderkey")


@query(
    "test_expression",
    with_layers(
        "SELECT inventory_id, quantity_on_hand FROM bronze_inventory WHERE NOT (quantity_on_hand > 0)",
        "bronze_inventory",
    ),
)
def test_expression(t: Retail):
    return quality.failing_rows(t.bronze_inventory, "quantity_on_hand > 0").select(
        "inventory_id", "quantity_on_hand"
    )


@query(
    "test_value_range",
    with_layers(
        "SELECT customer_id, age FROM silver_customers WHERE NOT (age BETWEEN 25 AND 80)",
        "silver_customers",
    ),
)
def test_value_range(t: Retail):
    return quality.out_of_range(t.silver_customers, "age", 25, 80).select("customer_id", "age")


@query(
    "test_no_negative_revenue",
    with_layers("SELECT order_id, net_amount FROM silver_orders WHERE net_amount < 0", "silver_orders"),
)
def test_no_negative_revenue(t: Retail):
    return t.silver_orders.where("net_amount < 0").select("order_id", "net_amount")


@query(
    "test_rfm_complete",
    with_layers(
        "SELECT customer_id FROM fact_orders WHERE is_completed = 1 AND customer_id NOT IN "
        "(SELECT customer_id FROM gold_customer_rfm)",
        "fact_orders",
        "gold_customer_rfm",
    ),
)
def test_rfm_complete(t: Retail):
    lines = materialize(t.order_lines.select(
        "customer_id", "order_id", "order_date", "net_amount", "is_completed"
    ), "order_lines")
    rfm = gold.customer_rfm(lines, t.dim_customer, t.as_of)
    buyers = lines.where("is_completed = 1").select("customer_id")
    return buyers.join(rfm.select("customer_id"), "customer_id", "left_anti")


@query(
    "test_no_negative_revenue_feed",
    with_layers(
        f"SELECT order_id, CAST(-1.0 AS DOUBLE) AS net_amount FROM bronze_orders WHERE {picked('orders', '1b')}",
        "bronze_orders",
    ),
)
def test_no_negative_revenue_feed(t: Retail):
    """The same test on a feed with broken rows, before cleaning takes them out."""
    return silver.typed_orders(broken_feed(t, "orders")).where("net_amount < 0").select("order_id", "net_amount")


@query(
    "test_rfm_complete_stale",
    with_layers(
        """SELECT customer_id FROM silver_orders WHERE status = 'Completed' GROUP BY customer_id
        HAVING customer_id IS NOT NULL AND MIN(order_date) >= DATE '1996-01-01'""",
        "silver_orders",
    ),
)
def test_rfm_complete_stale(t: Retail):
    """The completeness test on a report that ends with 1995: buyers who came later have no segment."""
    lines = t.order_lines.where("is_completed = 1 AND customer_id IS NOT NULL")
    rfm = gold.rfm_base(lines.where("order_date < '1996-01-01'"), t.as_of, orders_unique=True)
    return lines.select("customer_id").distinct().join(rfm.select("customer_id"), "customer_id", "left_anti")


def _test_sql(table: str, test: TableTest) -> str:
    name = test.name.replace("'", "''")
    if test.kind == "unique":
        failures = (
            f"(SELECT COUNT(*) FROM (SELECT {test.column} FROM {table} "
            f"WHERE {test.column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1))"
        )
        return f"SELECT '{table}' AS table_name, '{name}' AS test, {failures} AS failures"
    condition = {
        "not_null": f"{test.column} IS NULL",
        "expression": f"NOT ({test.column} {test.arg})",
        "range": f"NOT ({test.column} BETWEEN {test.arg[0]} AND {test.arg[1]})" if test.arg else "",
    }[test.kind]
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS test, "
        f"COUNT(*) FILTER (WHERE {condition}) AS failures FROM {table}"
    )


def _tests_sql(declared: dict[str, tuple[TableTest, ...]]) -> str:
    body = " UNION ALL ".join(_test_sql(table, x) for table, tests in declared.items() for x in tests)
    return with_layers(body, *declared)


def _run_declared(t: Retail, declared: dict[str, tuple[TableTest, ...]]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [quality.run_tests(getattr(t, table), tests, table) for table, tests in declared.items()],
    )


@query("run_source_tests", _tests_sql(SOURCE_TESTS))
def run_source_tests(t: Retail):
    return _run_declared(t, SOURCE_TESTS)


@query("run_silver_tests", _tests_sql(SILVER_TESTS))
def run_silver_tests(t: Retail):
    return _run_declared(t, SILVER_TESTS)


@query(
    "assert_schema_contract",
    with_layers(
        "SELECT order_id, quantity, net_amount, discount_pct, order_date FROM silver_orders",
        "silver_orders",
    ),
)
def assert_schema_contract(t: Retail):
    contract = schemas.struct(ORDER_CONTRACT)
    return quality.assert_contract(t.silver_orders, contract).select(*contract.fieldNames())
