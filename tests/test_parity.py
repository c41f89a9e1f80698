"""Every registered query against its reference SQL, on whole tables."""

import parity
import pytest

from shopgrain.catalog import REGISTRY

WITHOUT_SQL = {"sample_rows_seeded": None}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return parity.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql))
def test_matches_reference_sql(spark, sf_dir, duck, name):
    query = REGISTRY[name]
    assert parity.compare(query(spark, sf_dir), duck, query.sql) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs_without_reference_sql(spark, sf_dir, name):
    found = REGISTRY[name](spark, sf_dir).count()
    expected = WITHOUT_SQL[name]
    assert found > 0 if expected is None else found == expected


def test_all_queries_are_covered():
    assert {n for n, q in REGISTRY.items() if not q.sql} == set(WITHOUT_SQL)
