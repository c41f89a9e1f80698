import pytest

from shopgrain.operators import quality
from shopgrain.operators.quality import Rule, TableTest
from shopgrain.sources import schemas

RULES = [
    Rule("has_key", "k IS NOT NULL"),
    Rule("positive", "v > 0"),
    Rule("small", "v < 100", "warn"),
]


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [("a", 1), ("b", 0), (None, 5), (None, None), ("c", 500), ("c", 7)], "k string, v int"
    )


def test_kept_and_quarantined_partition_the_input(data, rows):
    checked = quality.apply_expectations(data, RULES)
    assert rows(checked.kept) == [("a", 1), ("c", 500), ("c", 7)]
    assert checked.kept.count() + checked.quarantined.count() == data.count()
    broken = {(r.k, r.v): r._failed_rules for r in checked.quarantined.collect()}
    assert broken == {
        ("b", 0): ["positive"],
        (None, 5): ["has_key"],
        (None, None): ["has_key", "positive"],
    }


def test_report_counts_unknown_as_failed(data, rows):
    report = quality.expectation_report(data, RULES)
    assert rows(report) == [
        ("has_key", "drop", 4, 2, 2),
        ("positive", "drop", 4, 2, 2),
        ("small", "warn", 4, 2, 0),
    ]


def test_table_tests(data, rows):
    tests = [
        TableTest("not_null", "k"),
        TableTest("unique", "k"),
        TableTest("expression", "v", "> 0"),
        TableTest("range", "v", (0, 100)),
    ]
    report = {r.test.split()[0]: r.failures for r in quality.run_tests(data, tests, "t").collect()}
    assert report == {"not_null": 2, "unique": 1, "expression": 1, "range": 1}


def test_contract(data):
    assert quality.contract_violations(data, schemas.struct("k string, v int"), strict=True) == []
    problems = quality.contract_violations(data, schemas.struct("k int, w int"), strict=True)
    assert problems == ["k: expected int, found string", "w: missing", "v: not declared"]
    with pytest.raises(ValueError, match="w: missing"):
        quality.assert_contract(data, schemas.struct("w int"))
