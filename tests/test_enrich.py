from datetime import datetime, timedelta

import pytest
from conftest import details, rows
from test_clean import make_orders

from millrace.functions.columns import bucket
from millrace.plans import orders, trips

START = datetime(2024, 3, 4, 12)


def make_trips(spark, *changes):
    base = dict(
        tpep_pickup_datetime=START,
        tpep_dropoff_datetime=START + timedelta(minutes=10),
        passenger_count=1,
        trip_distance=2.0,
        PULocationID=1,
        DOLocationID=2,
        payment_type=1,
        fare_amount=20.0,
        tip_amount=5.0,
        total_amount=30.0,
    )
    schema = (
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count int, trip_distance double, PULocationID int, DOLocationID int, "
        "payment_type int, fare_amount double, tip_amount double, total_amount double"
    )
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], schema)


def test_amounts_round_step_by_step(spark):
    raw = make_orders(spark, dict(quantity=1, unit_price=10.005, discount_pct=15))
    row = orders.add_revenue(raw).first()
    # 10.005 rounds half up as written; the discount is taken from 10.01.
    assert (row["gross_revenue"], row["discount_amount"], row["net_revenue"]) == (10.01, 1.5, 8.51)


@pytest.mark.parametrize(
    "value, label",
    [
        (49.99, "Small (<$50)"),
        (50.0, "Medium ($50-200)"),
        (199.99, "Medium ($50-200)"),
        (200.0, "Large ($200-500)"),
        (500.0, "Enterprise ($500+)"),
        (None, "Enterprise ($500+)"),
    ],
)
def test_revenue_bucket_edges(spark, value, label):
    df = spark.createDataFrame([(value,)], "net_revenue double")
    assert orders.add_revenue_bucket(df).first()["revenue_bucket"] == label


def test_bucket_needs_a_label_for_each_side():
    with pytest.raises(ValueError):
        bucket("x", (1, 2), ("a", "b"))


def test_order_calendar(spark):
    raw = make_orders(
        spark,
        dict(order_date=datetime(2023, 1, 1, 23)),  # a Sunday
        dict(order_date=datetime(2023, 12, 30, 0)),  # a Saturday
        dict(order_date=datetime(2023, 5, 31, 5)),  # a Wednesday
    )
    names = "order_year order_month order_quarter order_day_of_week is_weekend order_hour".split()
    assert rows(orders.add_calendar(raw).select(*names)) == [
        (2023, 1, 1, 1, True, 23),
        (2023, 12, 4, 7, True, 0),
        (2023, 5, 2, 4, False, 5),
    ]


def test_profit_ignores_discount_and_is_null_without_product(spark):
    df = spark.createDataFrame(
        [(10.0, 6.0, 3, 50), (10.0, None, 3, 0)],
        "unit_price double, cost_price double, quantity int, discount_pct int",
    )
    names = ("unit_profit", "total_profit", "profit_margin_pct")
    assert rows(orders.add_profit(df).select(*names)) == [(4.0, 12.0, 40.0), (None, None, None)]


def test_trip_metrics_guards(spark):
    df = make_trips(
        spark,
        {},
        dict(fare_amount=0.0),
        dict(fare_amount=-5.0),
        dict(trip_distance=0.0),
        dict(tpep_dropoff_datetime=START + timedelta(seconds=60)),
        dict(tpep_dropoff_datetime=START + timedelta(seconds=61)),
        dict(tpep_dropoff_datetime=None),
        dict(fare_amount=None),
    )
    names = ("trip_duration_min", "speed_mph", "tip_pct", "cost_per_mile")
    found = [tuple(r) for r in trips.add_metrics(df).select(*names).collect()]
    assert found == [
        (10.0, 12.0, 25.0, 10.0),
        (10.0, 12.0, 0.0, 0.0),
        (10.0, 12.0, 0.0, -2.5),
        (10.0, 0.0, 25.0, None),
        (1.0, None, 25.0, 10.0),
        (1.0, 118.0, 25.0, 10.0),
        (None, None, 25.0, 10.0),
        (10.0, 12.0, 0.0, None),
    ]


def test_duration_filter_uses_the_rounded_minutes(spark):
    seconds = {60: False, 61: False, 62: False, 63: True, 64: True, 10794: True, 10797: False}
    for length, kept in seconds.items():
        df = make_trips(spark, dict(tpep_dropoff_datetime=START + timedelta(seconds=length),
                                    trip_distance=0.5))
        assert trips.fact(df).count() == int(kept), length


def test_speed_filter(spark):
    ten_minutes = dict(tpep_dropoff_datetime=START + timedelta(minutes=10))
    slow, fast = dict(trip_distance=13.3, **ten_minutes), dict(trip_distance=13.4, **ten_minutes)
    assert trips.fact(make_trips(spark, slow)).count() == 1  # 79.8
    assert trips.fact(make_trips(spark, fast)).count() == 0  # 80.4


@pytest.mark.parametrize(
    "hour, part, rush",
    [
        (5, "Night", False),
        (6, "Morning", False),
        (7, "Morning", True),
        (9, "Morning", True),
        (10, "Morning", False),
        (11, "Morning", False),
        (12, "Afternoon", False),
        (16, "Afternoon", False),
        (17, "Evening", True),
        (19, "Evening", True),
        (20, "Evening", False),
        (21, "Evening", False),
        (22, "Night", False),
    ],
)
def test_hours(spark, hour, part, rush):
    df = make_trips(spark, dict(tpep_pickup_datetime=START.replace(hour=hour)))
    row = trips.add_calendar(df).first()
    assert (row["pickup_hour"], row["time_of_day"], row["is_rush_hour"]) == (hour, part, rush)


def test_day_names(spark):
    days = [START + timedelta(days=n) for n in range(7)]  # from a Monday on
    df = make_trips(spark, *(dict(tpep_pickup_datetime=d) for d in days))
    found = [r["day_name"] for r in trips.add_calendar(df).collect()]
    assert found == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def test_labels(spark):
    df = make_trips(
        spark,
        dict(fare_amount=9.99, trip_distance=0.99, payment_type=1, PULocationID=132),
        dict(fare_amount=10.0, trip_distance=1.0, payment_type=2, DOLocationID=138),
        dict(fare_amount=25.0, trip_distance=3.0, payment_type=3),
        dict(fare_amount=50.0, trip_distance=5.0, payment_type=4, PULocationID=None),
        dict(fare_amount=100.0, trip_distance=10.0, payment_type=0, DOLocationID=None),
        dict(fare_amount=None, trip_distance=None, payment_type=None,
             PULocationID=None, DOLocationID=132),
    )
    names = ("fare_bucket", "distance_bucket", "payment_name", "is_airport")
    assert [tuple(r) for r in trips.add_labels(df).select(*names).collect()] == [
        ("Under $10", "Under 1 mi", "Credit Card", True),
        ("$10-25", "1-3 mi", "Cash", True),
        ("$25-50", "3-5 mi", "No Charge", False),
        ("$50-100", "5-10 mi", "Dispute", False),
        ("$100+", "10+ mi", "Other", False),
        ("$100+", "10+ mi", "Other", True),
    ]


def test_zoned_timestamps_give_the_same_trips(spark, tmp_path):
    """The columns may be timestamps of the session's zone; filters still reach the reader."""
    plain = make_trips(spark, {}, dict(tpep_pickup_datetime=datetime(2023, 3, 4, 12)))
    zoned = plain.withColumns(
        {c: plain[c].cast("timestamp") for c in (trips.PICKUP, trips.DROPOFF)}
    )
    derived = [c for c in trips.fact(plain).columns if c not in plain.columns]
    assert len(derived) == 15
    assert rows(trips.fact(zoned).select(*derived)) == rows(trips.fact(plain).select(*derived))
    zoned.write.parquet(str(tmp_path / "z"))
    text = details(trips.clean(spark.read.parquet(str(tmp_path / "z"))))
    assert f"GreaterThanOrEqual({trips.PICKUP}" in text and f"LessThan({trips.PICKUP}" in text


def test_cleaning_ranges(spark):
    bad = [
        dict(fare_amount=0.0),
        dict(fare_amount=500.0),
        dict(fare_amount=float("nan")),
        dict(trip_distance=0.0),
        dict(trip_distance=200.0),
        dict(total_amount=0.0),
        dict(total_amount=500.0),
        dict(passenger_count=0),
        dict(passenger_count=7),
        dict(passenger_count=None),
        dict(tpep_pickup_datetime=datetime(2023, 12, 31, 23, 59, 59)),
        dict(tpep_pickup_datetime=datetime(2025, 1, 1), tpep_dropoff_datetime=datetime(2025, 1, 2)),
        dict(tpep_dropoff_datetime=START),
        dict(tpep_dropoff_datetime=None),
    ]
    assert trips.clean(make_trips(spark, *bad)).count() == 0
    good = [{}, dict(passenger_count=6), dict(
        tpep_pickup_datetime=datetime(2024, 1, 1), tpep_dropoff_datetime=datetime(2024, 1, 1, 1)
    )]
    assert trips.clean(make_trips(spark, *good)).count() == 3
    assert trips.rejected(make_trips(spark, *bad, *good)).count() == len(bad)
