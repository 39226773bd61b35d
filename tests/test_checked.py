"""Every checked query equals its SQL form in DuckDB."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pulsepanel.plans.checked import REGISTRY

QUERIES = {name: build for name, build in queries().items() if name in REGISTRY}
SQL = {name: sql for name, sql in oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["region", "date", "new_cases", "new_tests", "predicted_new_tests"]
    assert df.count() > 0
    assert df.where("predicted_new_tests is null").isEmpty()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, sf_dir, name):
    problems, n = compare.differences(spark, duck, QUERIES[name], SQL[name], sf_dir)
    assert not problems, problems
