import os

import pytest

from millrace.llm.queries import ORACLES, QUERIES
from verification.compare import compare, oracle_connection

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_duckdb(spark, name):
    problems, rows = compare(spark, oracle_connection(SMALL), SMALL, name)
    assert problems == [] and rows > 0


def test_every_operator_has_its_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
