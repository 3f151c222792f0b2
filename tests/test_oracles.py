"""Every query against DuckDB, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification import registry
from verification.compare import compare, oracle_connection


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_oracle(spark, con, sf_dir, name):
    problems, found = compare(spark, con, sf_dir, name)
    assert not problems
    assert found > 0


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(oracle_sql()) <= set(queries())


def test_flagship_is_the_report_over_the_fact(spark, sf_dir):
    expected = queries()["sql_top_categories"](spark, "/root/testdata/sf0.001").collect()
    assert entry(spark).collect() == expected
