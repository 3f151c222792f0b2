"""One place where every query meets its oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str) -> Callable[[Query], Query]:
    """Register a function under its own name, with the DuckDB text that must match it."""

    def register(run: Query) -> Query:
        @wraps(run)
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir.rstrip("/"))

        QUERIES[run.__name__] = configured
        ORACLES[run.__name__] = oracle
        return configured

    return register
