from conftest import plan, rows

from millrace.operators import audit
from millrace.operators.rules import Rule
from millrace.plans import trips

DATA = [(1, None, 0.0), (1, "x", -2.0), (None, None, None), (None, "y", 5.0)]
SCHEMA = "k int, s string, v double"


def test_null_profile(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(audit.null_profile(df)) == [("k", 2, 50.0), ("s", 2, 50.0), ("v", 1, 25.0)]
    assert audit.null_cells(df).first()[0] == 5


def test_null_profile_of_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(audit.null_profile(empty)) == [("k", 0, None), ("s", 0, None), ("v", 0, None)]


def test_null_profile_is_one_scan(spark, sf_dir):
    text = plan(audit.null_profile(spark.read.parquet(f"{sf_dir}/lineitem.parquet")))
    assert text.count("FileScan") == 1


def test_duplicates_count_null_as_a_value(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(audit.duplicate_keys(df, "k")) == [(4, 2, 2)]
    assert rows(audit.duplicate_keys(df, "k", "s")) == [(4, 4, 0)]
    assert rows(audit.duplicate_keys(df.limit(0), "k")) == [(0, 0, 0)]


def test_rule_counts_do_not_count_null_conditions(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    rules = [Rule("negative", "v < 0"), Rule("huge", "v > 500")]
    assert rows(audit.rule_counts(df, rules)) == [("huge", 0), ("negative", 1)]


def test_trip_rules(spark):
    trip = "fare_amount double, tip_amount double, trip_distance double, total_amount double, passenger_count int"
    df = spark.createDataFrame(
        [(501.0, -1.0, 0.0, 0.0, None), (0.0, 0.0, 1.0, -1.0, 0), (-1.0, 1.0, 1.0, 1.0, 1)], trip
    )
    assert dict(rows(audit.rule_counts(df, trips.AUDITED))) == {
        "negative_fares": 1,
        "zero_fares": 1,
        "negative_tips": 1,
        "zero_distance": 1,
        "non_positive_totals": 2,
        "fares_over_500": 1,
        "zero_passengers": 2,
    }


def test_distribution_keeps_null(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(audit.distribution(df, ["k", "s"])) == sorted(
        [("k", "1", 2), ("k", None, 2), ("s", None, 2), ("s", "x", 1), ("s", "y", 1)], key=repr
    )


def test_value_range(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    found = audit.value_range(df, {"v": "value"}).first().asDict()
    assert found == {"earliest_value": -2.0, "latest_value": 5.0}


def test_issue_summary_counts_rows_once_in_the_exact_column(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    low, bad = Rule("low", "v < 0"), Rule("negative_too", "v < -1")
    row = audit.issue_summary(df, [low, bad], [low, bad]).first()
    assert (row["total_issues"], row["rows_with_issue"]) == (2, 1)
    assert (row["issue_pct"], row["clean_rows_estimate"], row["clean_rows"]) == (50.0, 2, 3)


def test_profile_gives_what_the_single_audits_give(spark, sf_dir, tmp_path):
    from verification import stand_ins

    raw = stand_ins.raw_trips(spark, sf_dir)
    rules = [*trips.AUDITED, trips.OUT_OF_PERIOD]
    for i, df in enumerate((raw, raw.limit(0))):
        found = audit.Profile(
            df, str(tmp_path / f"p{i}"), rules, trips.CODE_COLUMNS, {trips.PICKUP: "pickup", trips.DROPOFF: "dropoff"}, rules
        )
        assert rows(found.nulls()) == rows(audit.null_profile(df))
        assert rows(found.rule_counts()) == rows(audit.rule_counts(df, rules))
        assert rows(found.distribution()) == rows(audit.distribution(df, trips.CODE_COLUMNS))
        assert rows(found.value_range()) == rows(audit.value_range(df, found.ranges))
        assert rows(found.issue_summary(trips.HEADLINE)) == rows(audit.issue_summary(df, trips.HEADLINE, rules))


def test_profile_is_one_scan_and_one_narrow_exchange(spark, sf_dir, tmp_path):
    from test_judge import exchanges, last_execution

    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    since = last_execution(spark)
    found = audit.Profile(df, str(tmp_path / "p"), [Rule("high", "value > 100")], ["event_type"], {"ts": "event"})
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert len(exchanges(spark, since)) == 1
    [scanned] = {f for r in (found.nulls(), found.distribution(), found.value_range()) for f in [plan(r).count(f"{sf_dir}")]}
    assert scanned == 0
