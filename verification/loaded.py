"""Both domains loaded once per session and source folder.

Summaries, reports, checks and verification read the written tables, as a user
of the star schema would; the load itself is timed as queries of its own.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import orders, trips
from millrace.session import fresh_dir
from verification import stand_ins

_lock = Lock()
_roots: dict[tuple[str, str, str], str] = {}


def load_orders(spark: SparkSession, sf_dir: str) -> str:
    """Run the orders load into a new folder and return the folder."""
    root = fresh_dir(spark, "orders")
    orders.run(
        spark,
        stand_ins.raw_orders(spark, sf_dir),
        stand_ins.products(spark, sf_dir),
        stand_ins.customers(spark, sf_dir),
        root,
        publish_failed=True,  # the stand-ins hold lines whose product no dimension has
    )
    return root


def load_trips(spark: SparkSession, sf_dir: str) -> str:
    root = fresh_dir(spark, "trips")
    trips.run(spark, stand_ins.raw_trips(spark, sf_dir), root, publish_failed=True)
    return root


def _root(spark: SparkSession, sf_dir: str, domain: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, domain)
    with _lock:
        if key not in _roots:
            _roots[key] = {"orders": load_orders, "trips": load_trips}[domain](spark, sf_dir)
        return _roots[key]


def orders_root(spark: SparkSession, sf_dir: str) -> str:
    return _root(spark, sf_dir, "orders")


def trips_root(spark: SparkSession, sf_dir: str) -> str:
    return _root(spark, sf_dir, "trips")


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.tables(spark, orders_root(spark, sf_dir))[orders.FACT]


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.tables(spark, trips_root(spark, sf_dir))[trips.FACT]
