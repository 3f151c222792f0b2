"""Deduplication, rules, casts, quarantine and step counts on hand-written rows."""

import math

import pytest
from conftest import details, plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.clean import (
    collapse,
    keep_one,
    mark_surplus,
    reason_counts,
    require,
    set_aside,
    step_counts,
    to_int,
)
from millrace.operators.rules import Rule
from millrace.plans import orders, trips
from millrace.sources.schemas import RAW_ORDERS
from verification import stand_ins

PAIRS = "k int, a int, b string"


def make_orders(spark, *changes):
    """One valid order per dict, with the changes applied."""
    from datetime import datetime

    base = dict(
        order_id=1,
        order_date=datetime(2023, 1, 1, 10),
        customer_id=5.0,
        product_id=7,
        quantity=2,
        unit_price=10.0,
        discount_pct=10,
        payment_method="Cash",
        status="Completed",
    )
    return spark.createDataFrame(
        [tuple({**base, **c}[f] for f in RAW_ORDERS.fieldNames()) for c in changes], RAW_ORDERS
    )


def test_keep_one_takes_least_row_nulls_first(spark):
    df = spark.createDataFrame(
        [(1, 2, "x"), (1, None, "z"), (1, None, "y"), (2, 1, "q"), (None, 3, "n"), (None, 2, "m")],
        PAIRS,
    )
    assert rows(keep_one(df, ["k"])) == rows(
        spark.createDataFrame([(1, None, "y"), (2, 1, "q"), (None, 2, "m")], PAIRS)
    )
    # Another leading column, another survivor.
    assert (1, 2, "x") in rows(keep_one(df, ["k"], ["b"]))


def test_keep_one_keeps_column_order_and_all_key_tables(spark):
    df = spark.createDataFrame([("x", 1), ("y", 1)], "b string, k int")
    assert keep_one(df, ["k"]).columns == ["b", "k"]
    keys = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(keep_one(keys, ["k"])) == [(1,), (2,)]
    assert rows(mark_surplus(keys, ["k"])) == [(1, False), (1, True), (2, False)]


def test_keep_one_merges_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, "x")], PAIRS)
    text = plan(keep_one(df, ["k"]))
    assert text.index("partial_min") > text.index("Exchange")  # printed from the top down
    assert text.count("Exchange") == 1


rows_strategy = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3)),
        st.one_of(st.none(), st.integers(0, 2)),
        st.sampled_from(["x", "y"]),
    ),
    max_size=30,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows_strategy, first=st.integers(1, 7), second=st.integers(1, 7))
def test_survivors_do_not_depend_on_partitions(spark, data, first, second):
    df = spark.createDataFrame(data, PAIRS)
    one, two = (keep_one(df.repartition(n), ["k"]) for n in (first, second))
    assert rows(one) == rows(two)
    assert one.count() == len({k for k, _, _ in data})


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows_strategy, parts=st.integers(1, 7))
def test_marks_split_rows_into_survivors_and_surplus(spark, data, parts):
    df = spark.createDataFrame(data, PAIRS)
    marked = mark_surplus(df.repartition(parts), ["k"])
    assert rows(marked.drop("is_surplus")) == rows(df)
    assert rows(marked.filter("not is_surplus").drop("is_surplus")) == rows(keep_one(df, ["k"]))


def test_hot_key_is_spread_over_tasks(spark):
    """A third of the rows share one key, partly as exact copies; no group is large."""
    n = 3000
    df = spark.range(n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 2).alias("a"),
    )
    marked = mark_surplus(df, ["k"])
    assert marked.filter("not is_surplus").count() == df.select("k").distinct().count()
    # The groups the two windows rank: at most one input task, or one row per task.
    lanes = df.withColumn("lane", F.spark_partition_id()).groupBy("k", "lane").count()
    assert lanes.agg(F.max("count")).first()[0] <= math.ceil(n / 16)


def test_collapse_counts_copies(spark):
    df = spark.createDataFrame([(1, 1, "x")] * 3 + [(2, 1, "x")], PAIRS)
    assert {r["k"]: r["__copies"] for r in collapse(df, ["k"]).collect()} == {1: 3, 2: 1}


def test_require_drops_null_conditions(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,), (float("nan"),)], "unit_price double")
    assert rows(require(df, [orders.HAS_PRICE])) == [(1.0,)]


def test_to_int_cuts_off_and_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([(7.9,), (-7.9,), (None,), (float("nan"),), (1e12,)], "x double")
    assert [r[0] for r in to_int(df, "x").collect()] == [7, -7, None, None, None]


def test_clean_orders_dedups_before_it_filters(spark):
    raw = make_orders(
        spark,
        # The invalid row sorts first, stays for its key and is then dropped.
        dict(order_id=1, unit_price=None),
        dict(order_id=1),
        dict(order_id=2),
        dict(order_id=3, unit_price=float("nan")),
        dict(order_id=4, unit_price=-3.0),
        dict(order_id=5, quantity=0),
        dict(order_id=6, customer_id=None),
        dict(order_id=7, customer_id=float("nan")),
        dict(order_id=None),
        dict(order_id=None, quantity=9),
    )
    assert [r["order_id"] for r in orders.clean(raw).collect()] == [2]
    assert orders.clean(raw).schema["customer_id"].dataType.simpleString() == "int"
    reasons = {(r["reason"], r["rows"]) for r in reason_counts(orders.rejected(raw)).collect()}
    assert reasons == {
        ("order_id_missing", 2),
        ("order_id_repeated", 1),
        ("unit_price_not_positive", 3),
        ("quantity_not_positive", 1),
        ("customer_id_missing", 2),
    }


def test_accepted_and_rejected_are_the_input(spark, sf_dir):
    raw = stand_ins.raw_orders(spark, sf_dir)
    typed = to_int(raw, "customer_id")
    both = orders.clean(raw).unionByName(orders.rejected(raw).drop("reason"))
    assert rows(both) == rows(typed)
    raw = stand_ins.raw_trips(spark, sf_dir)
    kept = trips.fact(raw).select(*raw.columns)
    assert rows(kept.unionByName(trips.rejected(raw).drop("reason"))) == rows(raw)


def test_set_aside_names_the_first_broken_rule(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, None), (1, 1)], "a int, b int")
    rules = [Rule("a_zero", "a > 0"), Rule("b_zero", "b > 0")]
    found = rows(set_aside(df, rules).select("a", "b", "reason"))
    assert found == [(0, 0, "a_zero"), (0, 1, "a_zero"), (1, None, "b_zero")]


@pytest.mark.parametrize("weight", [None, "__copies"])
def test_step_counts_of_no_rows(spark, weight):
    df = spark.createDataFrame([], "a int, __copies bigint")
    for row in step_counts(df, [Rule("positive", "a > 0")], weight).collect():
        assert (row["rows_before"], row["rows_after"], row["removed_pct"]) == (0, 0, None)


def test_period_filter_reaches_the_reader(spark, tmp_path):
    path = str(tmp_path / "trips")
    spark.sql(
        "select timestamp_ntz'2024-02-03 04:05:06' as tpep_pickup_datetime, 1 as x"
    ).write.parquet(path)
    text = details(require(spark.read.parquet(path), [trips.IN_PERIOD]))
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text
    assert "LessThan(tpep_pickup_datetime" in text
