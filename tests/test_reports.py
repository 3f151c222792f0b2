import re

from conftest import details, plan, rows
from pyspark.sql import functions as F

from millrace.operators.checks import gate
from millrace.operators.reports import top
from millrace.operators.summaries import summarise
from millrace.plans import orders, trips
from verification import loaded, stand_ins


def test_report_orders(spark, sf_dir):
    """The comparison with the oracle ignores row order; this does not."""
    fact = loaded.fact_orders(spark, sf_dir)
    months = [(r[0], r[1]) for r in orders.report("monthly_revenue", fact).collect()]
    assert months == sorted(months)
    expected = fact.where("status = 'Completed'").select(*orders.PARTITIONED_BY).distinct().count()
    assert len(set(months)) == len(months) == expected
    found = orders.report("top_categories", fact).collect()
    # Lines without a product have no profit and come last.
    profit = [r["profit"] for r in found if r["category"]]
    assert profit == sorted(profit, reverse=True)
    found = orders.report("segment", fact).collect()
    per_customer = [r["revenue_per_customer"] for r in found]
    assert per_customer == sorted(per_customer, reverse=True)
    sizes = [r["revenue_bucket"] for r in orders.report("order_size", fact).collect()]
    assert sizes == list(orders.REVENUE_LABELS)
    fact = loaded.fact_trips(spark, sf_dir)
    labels = [r["fare_bucket"] for r in trips.report("fare_bucket", fact).collect()]
    assert labels == [x for x in trips.FARE_LABELS if x in labels]
    days = [r["pickup_day_of_week"] for r in trips.report("dow", fact).collect()]
    assert days == sorted(days)
    months = [r["pickup_month"] for r in trips.report("monthly", fact).collect()]
    assert months == sorted(months)


def test_top_keeps_the_best_of_each_task(spark):
    df = spark.range(1000, numPartitions=8)
    best = top(df, 3, F.desc("id"))
    assert [r[0] for r in best.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in plan(best)


def test_reports_read_only_their_columns(spark, sf_dir):
    text = details(orders.report("order_size", loaded.fact_orders(spark, sf_dir)))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"status", "net_revenue", "revenue_bucket"}
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,Completed)]" in text


def test_every_check_counts(spark):
    checks = "check string, failures long, verdict string"
    passed = spark.createDataFrame([("a", 0, "PASS"), ("b", 0, "PASS")], checks)
    assert rows(gate(passed)) == [(2, 0, "SUCCESS")]
    failed = spark.createDataFrame([("a", 0, "PASS"), ("null_durations", 2, "FAIL")], checks)
    assert rows(gate(failed)) == [(2, 2, "FAILED")]
    assert rows(gate(passed.limit(0))) == [(0, 0, "SUCCESS")]


def test_null_duration_fails_the_trip_checks(spark):
    df = spark.sql(
        """select 5.0D as fare_amount, 1.0D as trip_distance, cast(null as double)
           as trip_duration_min, timestamp_ntz'2024-05-01 00:00:00' as tpep_pickup_datetime"""
    )
    assert dict((r["check"], r["verdict"]) for r in trips.checks(df).collect()) == {
        "negative_fares": "PASS",
        "zero_distance": "PASS",
        "null_durations": "FAIL",
        "wrong_year": "PASS",
    }


def test_next_time_equals_a_plain_window(spark, sf_dir):
    from pyspark.sql import Window

    events = stand_ins.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    # One user with a third of the events, several of them in one minute.
    hot = events.withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id"))
    ).withColumn("ts", F.when(F.col("event_id") % 5 == 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).otherwise(F.col("ts")))
    plain = hot.withColumn(
        "next_ts", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    )
    assert rows(stand_ins.with_next_time(stand_ins.in_user_time_ranges(hot))) == rows(plain)


def test_no_python_runs_per_row(spark, sf_dir):
    parts = [f(spark, sf_dir) for f in (stand_ins.raw_orders, stand_ins.products, stand_ins.customers)]
    for df in (orders.fact(*parts), trips.fact(stand_ins.raw_trips(spark, sf_dir))):
        assert "EvalPython" not in plan(df) and "InPandas" not in plan(df)


def test_distinct_values_travel_without_the_states_of_other_measures(spark):
    """Each distinct customer took the sums and counts of all measures through the shuffle."""
    kind = "order_date timestamp, status string, order_id int, net_revenue double, total_profit double, customer_id int, is_weekend boolean"
    df = spark.createDataFrame(
        [(None, "Completed", 1, 2.0, 1.0, 5, True), (None, "Completed", 2, 3.0, None, None, False), (None, "Completed", 3, 4.0, None, 5, None)],
        kind,
    )
    daily = summarise(df, orders.DAILY)
    exchanged = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: (.*)\n", details(daily), re.M)
    by_value = [columns for columns in exchanged if "__value#" in columns]
    assert by_value and not any("sum#" in columns for columns in by_value)
    assert rows(daily) == [(None, 3, 9.0, 1.0, 3.0, 1, 1)]
    assert rows(summarise(df.limit(0), orders.DAILY)) == []
