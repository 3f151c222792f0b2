import json
import os
import re

from conftest import details, plan, rows
from pyspark.sql import functions as F
from test_clean import make_orders
from test_enrich import make_trips

from millrace.operators.reuse import reused
from millrace.plans import orders, trips
from millrace.plans.reload import reload_partitions
from millrace.plans.runlog import read_log
from millrace.sources import versions, writers
from verification import stand_ins


def parquet_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_partitioned_write_has_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000, numPartitions=16).withColumn("p", F.col("id") % 4)
    writers.write_partitioned(df, path, ["p"])
    assert len(parquet_files(path)) == 4
    back = spark.read.parquet(path)
    assert back.columns == ["id", "p"]
    assert back.count() == 1000


def test_large_partition_is_written_by_several_tasks(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    path = str(tmp_path / "t")
    df = spark.range(60_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(1).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    writers.write_partitioned(df, path, ["p"])
    assert len(parquet_files(f"{path}/p=1")) > 3


def test_static_overwrite_drops_and_dynamic_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([(1, 1), (2, 2)], "v int, p int")
    one = spark.createDataFrame([(3, 2)], "v int, p int")
    writers.write_partitioned(both, path, ["p"])
    writers.write_partitioned(one, path, ["p"], only_touched=True)
    assert rows(spark.read.parquet(path)) == [(1, 1), (3, 2)]
    writers.write_partitioned(one, path, ["p"])
    assert rows(spark.read.parquet(path)) == [(3, 2)]


def test_null_partition_values_are_counted(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5)], "v int, p int")
    writers.write_partitioned(df, path, ["p"])
    written = spark.read.parquet(path)
    assert rows(writers.verify_partitions(written, ["p"])) == [(2, 1)]
    assert rows(writers.verify_tables({"t": written})) == [("t", 3, 2)]


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"])
    text = plan(spark.read.parquet(path).filter("p = 1"))
    assert "PartitionFilters: [isnotnull(p" in text


def test_reused_computes_once_and_lets_go(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    with reused(df) as cached:
        assert cached.count() == 100
        assert "InMemoryTableScan" in plan(cached.filter("x > 3"))
    assert not df.is_cached


def dims(spark):
    products = spark.createDataFrame(
        [(7, "p", "Toys", "b", 4.0, True)],
        "product_id long, product_name string, category string, brand string, "
        "cost_price double, is_active boolean",
    )
    customers = spark.createDataFrame(
        [(5, "c", "Austin", "USA", "Budget")],
        "customer_id int, customer_name string, city string, country string, "
        "customer_segment string",
    )
    return products, customers


def test_orders_run_end_to_end(spark, tmp_path):
    root = str(tmp_path / "star")
    raw = make_orders(
        spark, dict(order_id=1), dict(order_id=1), dict(order_id=2, quantity=0), dict(order_id=3)
    )
    log = orders.run(spark, raw, *dims(spark), root, quarantine=True).first()
    assert log["status"] == "SUCCESS" and log["quality_checks"]["all_passed"]
    assert log["extract"] == {"orders_raw": 4, "products_raw": 1, "customers_raw": 1}
    assert log["transform"]["rows_removed"] == 2
    assert log["transform"]["removal_rate_pct"] == 50.0
    assert log["load"]["rows"]["fact_orders_rows"] == 2
    assert log["load"]["partition_columns"] == ["order_year", "order_month"]
    assert versions.read(spark, root, "rejected_orders").count() == 2
    daily = orders.tables(spark, root)["agg_daily_summary"].collect()
    # 2 x 10.00 less 10 %, twice, by one customer on a Sunday.
    assert [(r["total_orders"], r["total_revenue"], r["unique_customers"], r["weekend_orders"])
            for r in daily] == [(2, 36.0, 1, 2)]
    stored = [n for n in os.listdir(f"{root}/run_log") if n.endswith(".json")]
    assert len(stored) == 1
    with open(f"{root}/run_log/{stored[0]}") as f:
        assert json.loads(f.read())["pipeline_name"] == "orders"
    # A second run adds its own line.
    orders.run(spark, raw, *dims(spark), root)
    assert read_log(spark, f"{root}/run_log").count() == 2


def test_amounts_that_no_sum_can_hold_are_left_out_or_reported(spark, tmp_path):
    raw = make_orders(
        spark,
        dict(order_id=1),
        dict(order_id=2, unit_price=float("inf")),
        dict(order_id=3, unit_price=float("nan")),
        dict(order_id=4, unit_price=5.4e16),
        dict(order_id=5, unit_price=5.4e27),
    )
    root = str(tmp_path / "star")
    assert orders.run(spark, raw, *dims(spark), root).first()["status"] == "SUCCESS"
    fact = orders.tables(spark, root)["fact_orders"]
    assert sorted(r["order_id"] for r in fact.collect()) == [1, 4, 5]
    [day] = orders.tables(spark, root)["agg_daily_summary"].collect()
    # The third value is too large for the sum and its mean alike.
    assert day["total_revenue"] > 9e16 and day["avg_order_value"] * 2 == day["total_revenue"]
    odd = fact.withColumn("net_revenue", F.lit(float("inf")))
    failures = {r["check"]: r["failures"] for r in orders.checks(odd).collect()}
    assert failures["non_finite_revenue"] == 3
    assert failures["non_finite_profit"] == 0
    odd = fact.withColumn("total_profit", F.lit(float("-inf")))
    assert {r["check"]: r["failures"] for r in orders.checks(odd).collect()}["non_finite_profit"] == 3


def test_a_tip_that_is_not_finite_is_rejected(spark):
    raw = make_trips(spark, {}, dict(tip_amount=float("inf")), dict(tip_amount=float("nan")))
    assert trips.fact(raw).count() == 1
    assert {r["reason"] for r in trips.rejected(raw).collect()} == {"tip_not_finite"}


def test_unreadable_lines_go_to_quarantine_whole(spark):
    raw = make_orders(spark, dict(order_id=1), dict(order_id=2), dict(order_id=2, quantity=None))
    marked = raw.withColumn("_corrupt_record", F.when(F.col("quantity").isNull(), "2,...,x"))
    assert rows(orders.clean(marked).select("order_id", "quantity")) == [(1, 2), (2, 2)]
    assert "_corrupt_record" not in orders.fact(marked, *dims(spark)).columns
    bad = orders.rejected(marked).collect()
    assert [(r["order_id"], r["reason"], r["_corrupt_record"]) for r in bad] == [(2, "cell_unreadable", "2,...,x")]


def test_unknown_product_fails_the_gate(spark, tmp_path):
    raw = make_orders(spark, dict(order_id=1), dict(order_id=2, product_id=99))
    log = orders.run(spark, raw, *dims(spark), str(tmp_path / "star")).first()
    assert log["status"] == "FAILED"
    assert log["quality_checks"]["failures"]["null_category"] == 1


def test_runs_on_empty_input(spark, tmp_path):
    log = orders.run(spark, make_orders(spark, {}).limit(0), *dims(spark), str(tmp_path / "o"))
    row = log.first()
    assert row["status"] == "SUCCESS"
    assert row["transform"]["removal_rate_pct"] is None


def test_trips_run_end_to_end(spark, tmp_path):
    raw = make_trips(spark, {}, {}, dict(fare_amount=-1.0), dict(passenger_count=None))
    root = str(tmp_path / "t")
    log = trips.run(spark, raw, root, quarantine=True).first()
    assert log["status"] == "SUCCESS"
    assert log["transform"]["rows_before_cleaning"] == 4
    assert log["transform"]["quality_issues_found"]["negative_fares"] == 1
    assert log["load"]["rows"]["fact_trips_rows"] == 2
    assert log["transform"]["columns_added"] == 15 and log["transform"]["rows_after_cleaning"] == 2
    assert [s["step"] for s in log["transform"]["steps"]][-1] == "all"
    assert set(log["stages_ended_at"]) == {"extract", "transform", "load", "checks"}
    assert log["extract_columns"] == {"trips_raw": len(raw.columns)} and log["extract"] == {"trips_raw": 4}
    assert log["load"]["partition_columns"] == ["pickup_month"]
    assert versions.read(spark, root, "rejected_trips").count() == 2
    empty = trips.run(spark, raw.limit(0), str(tmp_path / "e")).first()
    assert empty["load"]["partitions"] == 0 and empty["status"] == "SUCCESS"


def test_fact_rows_are_the_sum_of_each_summary(spark, sf_dir):
    fact = trips.fact(stand_ins.raw_trips(spark, sf_dir)).cache()
    for name in trips.SUMMARIES:
        column = "total_trips" if name == "agg_daily" else "trips"
        assert trips.summary(name, fact).agg(F.sum(column)).first()[0] == fact.count()
    fact.unpersist()


def fact_of(spark):
    return lambda raw: orders.fact(raw, *dims(spark))


def load(spark, raw, path):
    orders.write_fact(raw, *dims(spark), path)


def test_reload_moves_a_row_and_drops_an_emptied_partition(spark, tmp_path):
    from datetime import datetime

    history = make_orders(
        spark,
        dict(order_id=1, order_date=datetime(2023, 5, 1)),
        dict(order_id=2, order_date=datetime(2023, 3, 1)),
    )
    # A duplicate that sorts first takes the place of the May row.
    batch = make_orders(
        spark,
        dict(order_id=1, order_date=datetime(2023, 4, 1)),
        dict(order_id=3, order_date=datetime(2023, 4, 2)),
    )
    path, full = str(tmp_path / "fact"), str(tmp_path / "full")
    load(spark, history, path)
    untouched = f"{path}/order_year=2023/order_month=3"
    before = sorted(os.listdir(untouched))
    rewritten = reload_partitions(
        spark, path, history, batch, fact_of(spark), "order_id", orders.PARTITIONED_BY
    )
    load(spark, history.union(batch), full)
    assert rewritten == 2
    assert rows(spark.read.parquet(path)) == rows(spark.read.parquet(full))
    assert not os.path.exists(f"{path}/order_year=2023/order_month=5")
    assert sorted(os.listdir(untouched)) == before


def reload_by(spark, tmp_path, history, batch):
    """Reload of rows (k, v, p) whose least v stays, next to a full load."""
    from millrace.operators.clean import keep_one

    build = lambda raw: keep_one(raw, ["k"], ["v"])
    path, full = str(tmp_path / "fact"), str(tmp_path / "full")
    writers.write_partitioned(build(history), path, ["p"])
    count = reload_partitions(spark, path, history, batch, build, "k", ["p"])
    writers.write_partitioned(build(history.union(batch)), full, ["p"])
    assert rows(spark.read.parquet(path)) == rows(spark.read.parquet(full))
    assert sorted(os.listdir(tmp_path)) == ["fact", "full"]  # no staging is left
    assert sorted(p for p in os.listdir(path) if "=" in p) == sorted(p for p in os.listdir(full) if "=" in p)
    return count


def test_reload_with_odd_partition_values(spark, tmp_path):
    kind = "k int, v int, p string"
    history = spark.createDataFrame(
        [(1, 5, "a:b"), (2, 5, "c/d e"), (3, 5, None), (4, 5, "stays"), (5, 5, "100%")], kind
    )
    batch = spark.createDataFrame([(1, 1, "new"), (2, 1, "n:w"), (3, 1, "stays"), (5, 1, None)], kind)
    assert reload_by(spark, tmp_path, history, batch) == 7


def test_reload_of_many_partitions(spark, tmp_path):
    rows_of = "id as k", "cast(id % 3 as int) as v", "cast(id % 1500 as int) as p"
    history = spark.range(3000).selectExpr(*rows_of)
    batch = spark.range(0, 3000, 2).selectExpr("id as k", "-1 as v", "cast(id % 1500 as int) as p")
    assert reload_by(spark, tmp_path, history, batch) == 750


def test_reload_again_after_a_failure_before_the_deletes(spark, tmp_path, monkeypatch):
    import pytest

    from millrace.sources import storage

    kind = "k int, v int, p string"
    history = spark.createDataFrame([(1, 5, "old"), (2, 5, "stays")], kind)
    batch = spark.createDataFrame([(1, 1, "new")], kind)
    real = storage.delete_uri

    def fail(*_):
        raise OSError("gone")

    from millrace.operators.clean import keep_one

    build = lambda raw: keep_one(raw, ["k"], ["v"])
    path = str(tmp_path / "fact")
    writers.write_partitioned(build(history), path, ["p"])
    monkeypatch.setattr(storage, "delete_uri", fail)
    with pytest.raises(OSError):
        reload_partitions(spark, path, history, batch, build, "k", ["p"])
    monkeypatch.setattr(storage, "delete_uri", real)
    reload_partitions(spark, path, history, batch, build, "k", ["p"])
    assert rows(spark.read.parquet(path)) == [(1, 1, "new"), (2, 5, "stays")]


def test_reload_of_nothing_changes_nothing(spark, tmp_path):
    history = make_orders(spark, dict(order_id=1))
    path = str(tmp_path / "fact")
    load(spark, history, path)
    assert 0 == reload_partitions(
        spark, path, history, history.limit(0), fact_of(spark), "order_id", orders.PARTITIONED_BY
    )
    assert spark.read.parquet(path).count() == 1


def test_reload_below_a_bare_name(spark, tmp_path):
    from millrace.sources import storage

    here = storage.parent(spark, "fact_orders")
    assert here == storage.parent(spark, f"{here}/fact_orders") and not here.endswith(":/")


def test_sources_are_named_in_the_log(spark, tmp_path):
    raw = make_orders(spark, dict(order_id=1), dict(order_id=2))
    path = str(tmp_path / "raw csv")
    raw.repartition(2).write.option("header", True).csv(path)
    from millrace.sources.readers import read_csv
    from millrace.sources.schemas import RAW_ORDERS

    log = orders.run(spark, read_csv(spark, path, schema=RAW_ORDERS), *dims(spark), str(tmp_path / "star")).first()
    named = log["sources"]["orders_raw"]
    assert named["source_format"] == "csv"
    assert named["source_files"] == sorted(f for f in os.listdir(path) if f.endswith(".csv"))
    assert log["sources"]["products_raw"]["source_files"] == []


def test_a_join_of_the_fact_that_shuffles_carries_raw_columns_only(spark, conf, tmp_path):
    """Products and derived columns went through the customers' shuffle, and derived ones to the files' tasks."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    raw = make_orders(spark, *(dict(order_id=i) for i in range(9)))
    text = details(orders.fact(raw, *dims(spark)))
    carried = [c for c in re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: (.*)\n", text, re.M) if "payment_method#" in c]
    assert carried and not any("net_revenue#" in c or "total_profit#" in c for c in carried)
    [by_customer] = [c for c in carried if "customer_name#" not in c]
    assert by_customer.count("#") == 9
    out = orders.write_fact(raw, *dims(spark), str(tmp_path / "fact"))
    built = orders.fact(raw, *dims(spark))
    assert rows(out.select(*built.columns)) == rows(built)
