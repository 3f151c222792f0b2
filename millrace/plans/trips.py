"""Taxi-style trips: one raw table to a fact table and four summaries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import mergeable
from millrace.functions.columns import band, bucket, elapsed_seconds, flag, label, year_is
from millrace.operators.audit import rule_counts
from millrace.operators.checks import check_rules, gate
from millrace.operators.clean import require, set_aside, step_counts
from millrace.operators.judge import all_rows, kept_rows, rejected_rows, write_judged
from millrace.operators.reports import Report
from millrace.operators.rules import ALL_ROWS, Rule
from millrace.operators.summaries import Summary, summarise
from millrace.plans.runlog import ALTERED, StageClock, logged_failure, reload_log, run_log
from millrace.plans.survivors import Fact, merge_summaries, write_states
from millrace.session import fresh_dir, scratch_scope
from millrace.sources import ledger as ledgers
from millrace.sources import versions
from millrace.sources.readers import read_parquet
from millrace.sources.versions import Draft
from millrace.sources.writers import (
    append_json,
    at_once,
    spread,
    verify_partitions,
    verify_tables,
    write_partitioned,
    write_table,
    write_tables,
)

FACT = "fact_trips"
TAKE_IN = "trips_files"
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PARTITIONED_BY = ("pickup_month",)
YEAR = 2024

# Names, ranges and edges of the derived columns.
DAY_NAMES = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri"}
OTHER_DAY = "Sat"
TIMES_OF_DAY = {"Morning": (6, 11), "Afternoon": (12, 16), "Evening": (17, 21)}
OTHER_TIME = "Night"
RUSH_HOURS = ((7, 9), (17, 19))
AIRPORT_ZONES = (132, 138)
PAYMENT_NAMES = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
OTHER_PAYMENT = "Other"
FARE_EDGES = (10, 25, 50, 100)
FARE_LABELS = ("Under $10", "$10-25", "$25-50", "$50-100", "$100+")
DISTANCE_EDGES = (1, 3, 5, 10)
DISTANCE_LABELS = ("Under 1 mi", "1-3 mi", "3-5 mi", "5-10 mi", "10+ mi")

RANGES = (
    Rule("fare_out_of_range", "fare_amount > 0 and fare_amount < 500"),
    Rule("distance_out_of_range", "trip_distance > 0 and trip_distance < 200"),
    Rule("total_out_of_range", "total_amount > 0 and total_amount < 500"),
    Rule("passengers_out_of_range", "passenger_count > 0 and passenger_count <= 6"),
    Rule("tip_not_finite", "tip_amount is null or abs(tip_amount) < double('Infinity')"),
)
TIME_ORDER = Rule("not_in_time_order", f"{PICKUP} < {DROPOFF}")


def in_period(year: int = YEAR) -> Rule:
    return Rule("outside_period", year_is(PICKUP, year))


def out_of_period(year: int = YEAR) -> Rule:
    return Rule("wrong_year", f"not ({in_period(year).condition})")


def cleaning(year: int = YEAR) -> tuple[Rule, ...]:
    return (*RANGES, in_period(year), TIME_ORDER)


IN_PERIOD, OUT_OF_PERIOD, CLEANING = in_period(), out_of_period(), cleaning()

# On the rounded derived values: 61 seconds round to 1.0 minute and are out.
PLAUSIBLE = (
    Rule("duration_implausible", "trip_duration_min > 1 and trip_duration_min < 180"),
    Rule("speed_implausible", "speed_mph is null or speed_mph < 80"),
)

NEGATIVE_FARE = Rule("negative_fares", "fare_amount < 0")
ZERO_FARE = Rule("zero_fares", "fare_amount = 0")
NEGATIVE_TIP = Rule("negative_tips", "tip_amount < 0")
ZERO_DISTANCE = Rule("zero_distance", "trip_distance = 0")
NO_TOTAL = Rule("non_positive_totals", "total_amount <= 0")
HUGE_FARE = Rule("fares_over_500", "fare_amount > 500")
NO_PASSENGERS = Rule("zero_passengers", "passenger_count = 0 or passenger_count is null")

AUDITED = (
    NEGATIVE_FARE,
    ZERO_FARE,
    NEGATIVE_TIP,
    ZERO_DISTANCE,
    NO_TOTAL,
    HUGE_FARE,
    NO_PASSENGERS,
)
# The issues the audit's headline number adds up.
HEADLINE = (NEGATIVE_FARE, ZERO_DISTANCE, NO_TOTAL, OUT_OF_PERIOD, NO_PASSENGERS)
CODE_COLUMNS = ("VendorID", "payment_type", "RatecodeID")

CHECKS = (
    NEGATIVE_FARE,
    Rule("zero_distance", "trip_distance <= 0"),
    Rule("null_durations", "trip_duration_min is null"),
)

# Amounts and distances come unrounded, so their sums keep six decimals.
_M_FARE = mergeable.rounded(mergeable.mean("fare_amount", 6), 2)
_M_DISTANCE = mergeable.rounded(mergeable.mean("trip_distance", 6), 2)
_M_DURATION = mergeable.rounded(mergeable.mean("trip_duration_min", 1), 1)
_M_SPEED = mergeable.rounded(mergeable.mean("speed_mph", 1), 1)
_M_TIP_PCT = mergeable.rounded(mergeable.mean("tip_pct", 1), 1)
_M_REVENUE = mergeable.rounded(mergeable.total("total_amount", 6), 0)
# Reports use the same measures as SQL text.
_FARE, _DISTANCE, _DURATION = _M_FARE.sql, _M_DISTANCE.sql, _M_DURATION.sql
_SPEED, _TIP_PCT, _REVENUE = _M_SPEED.sql, _M_TIP_PCT.sql, _M_REVENUE.sql

SUMMARIES = {
    "agg_daily": Summary(
        keys={"pickup_date": "pickup_date"},
        measures={
            "total_trips": mergeable.count("*"),
            "total_fares": mergeable.rounded(mergeable.total("fare_amount", 6), 2),
            "total_tips": mergeable.rounded(mergeable.total("tip_amount", 6), 2),
            "total_revenue": mergeable.rounded(mergeable.total("total_amount", 6), 2),
            "avg_fare": _M_FARE,
            "avg_distance": _M_DISTANCE,
            "avg_duration": _M_DURATION,
            "avg_tip_pct": _M_TIP_PCT,
            "avg_speed": _M_SPEED,
            "airport_trips": mergeable.count_if("is_airport"),
            "rush_hour_trips": mergeable.count_if("is_rush_hour"),
        },
    ),
    "agg_hourly": Summary(
        keys={"pickup_hour": "pickup_hour", "time_of_day": "time_of_day"},
        measures={
            "trips": mergeable.count("*"),
            "avg_fare": _M_FARE,
            "avg_distance": _M_DISTANCE,
            "avg_speed": _M_SPEED,
            "avg_tip_pct": _M_TIP_PCT,
        },
    ),
    "agg_zones": Summary(
        keys={"PULocationID": "PULocationID"},
        measures={
            "trips": mergeable.count("*"),
            "total_revenue": _M_REVENUE,
            "avg_fare": _M_FARE,
            "avg_distance": _M_DISTANCE,
            "avg_tip_pct": _M_TIP_PCT,
        },
    ),
    "agg_payment": Summary(
        keys={"payment_name": "payment_name", "pickup_month": "pickup_month"},
        measures={"trips": mergeable.count("*"), "revenue": _M_REVENUE, "avg_tip_pct": _M_TIP_PCT},
    ),
}

VIEW = "trips_fact"
_FARE_RANK = " ".join(f"when '{name}' then {i}" for i, name in enumerate(FARE_LABELS))

REPORTS = {
    "monthly": Report(
        VIEW,
        f"""
        select pickup_month, count(*) as trips, {_REVENUE} as revenue, {_FARE} as avg_fare,
               {_DISTANCE} as avg_distance, {_TIP_PCT} as avg_tip_pct
        from {VIEW} group by pickup_month order by pickup_month
        """,
    ),
    "rush": Report(
        VIEW,
        f"""
        select is_rush_hour, count(*) as trips, {_FARE} as avg_fare,
               {_DURATION} as avg_duration, {_SPEED} as avg_speed
        from {VIEW} where speed_mph is not null group by is_rush_hour
        """,
    ),
    "airport": Report(
        VIEW,
        f"""
        select is_airport, count(*) as trips, {_FARE} as avg_fare,
               {_DISTANCE} as avg_distance, {_TIP_PCT} as avg_tip_pct
        from {VIEW} group by is_airport
        """,
    ),
    "fare_bucket": Report(
        VIEW,
        f"""
        select fare_bucket, count(*) as trips, {_REVENUE} as total_revenue,
               {_DISTANCE} as avg_distance
        from {VIEW} group by fare_bucket order by case fare_bucket {_FARE_RANK} end
        """,
    ),
    "dow": Report(
        VIEW,
        f"""
        select day_name, pickup_day_of_week, count(*) as trips, {_FARE} as avg_fare,
               {_REVENUE} as total_revenue
        from {VIEW} group by day_name, pickup_day_of_week order by pickup_day_of_week
        """,
    ),
}


def clean(raw: DataFrame, year: int = YEAR) -> DataFrame:
    return require(raw, cleaning(year))


def add_metrics(df: DataFrame) -> DataFrame:
    seconds = elapsed_seconds(PICKUP, DROPOFF)
    speed = F.round(F.try_divide("trip_distance", seconds / 3600), 1)
    tip = F.round(F.try_divide("tip_amount", "fare_amount") * 100, 1)
    per_mile = F.round(F.try_divide("fare_amount", "trip_distance"), 2)
    return df.withColumns(
        {
            "trip_duration_min": F.round(seconds / 60, 1),
            "speed_mph": F.when(seconds > 60, speed),
            "tip_pct": F.when(F.col("fare_amount") > 0, tip).otherwise(0.0),
            "cost_per_mile": F.when(F.col("trip_distance") > 0, per_mile),
        }
    )


def add_calendar(df: DataFrame) -> DataFrame:
    parts = df.withColumns(
        {
            "pickup_hour": F.hour(PICKUP),
            "pickup_date": F.to_date(PICKUP),
            "pickup_month": F.month(PICKUP),
            "pickup_day_of_week": F.dayofweek(PICKUP),
        }
    )
    rush = [F.col("pickup_hour").between(low, high) for low, high in RUSH_HOURS]
    return parts.withColumns(
        {
            "day_name": label("pickup_day_of_week", DAY_NAMES, OTHER_DAY),
            "time_of_day": band("pickup_hour", TIMES_OF_DAY, OTHER_TIME),
            "is_rush_hour": flag(rush[0] | rush[1]),
        }
    )


def add_labels(df: DataFrame) -> DataFrame:
    at_airport = [F.col(c).isin(*AIRPORT_ZONES) for c in ("PULocationID", "DOLocationID")]
    return df.withColumns(
        {
            "is_airport": flag(at_airport[0] | at_airport[1]),
            "payment_name": label("payment_type", PAYMENT_NAMES, OTHER_PAYMENT),
            "fare_bucket": bucket("fare_amount", FARE_EDGES, FARE_LABELS),
            "distance_bucket": bucket("trip_distance", DISTANCE_EDGES, DISTANCE_LABELS),
        }
    )


def enrich(cleaned: DataFrame) -> DataFrame:
    """Fifteen derived columns."""
    return add_labels(add_calendar(add_metrics(cleaned)))


def plausible(raw: DataFrame, year: int = YEAR) -> DataFrame:
    """Clean rows whose derived duration and speed are plausible; raw columns only."""
    return require(add_metrics(clean(raw, year)), PLAUSIBLE).select(*raw.columns)


def fact(raw: DataFrame, year: int = YEAR) -> DataFrame:
    return enrich(plausible(raw, year))


def _by_month(rows: DataFrame) -> DataFrame:
    """Fact rows of plausible ones; they move to their partition while narrow."""
    moved = spread(rows.withColumn("pickup_month", F.month(PICKUP)), *PARTITIONED_BY)
    return enrich(moved.select(*rows.columns))


def write_fact(raw: DataFrame, path: str, year: int = YEAR) -> DataFrame:
    """Write the fact and read it back."""
    built = _by_month(plausible(raw, year))
    write_partitioned(built, path, PARTITIONED_BY, already_spread=True)
    return read_parquet(raw.sparkSession, path, schema=built.schema)


def rejected(raw: DataFrame, year: int = YEAR) -> DataFrame:
    """Every raw row that ``fact`` leaves out, with the reason."""
    measured = set_aside(add_metrics(raw), [*cleaning(year), *PLAUSIBLE])
    return measured.select(*raw.columns, "reason")


def judge(raw: DataFrame, year: int = YEAR) -> DataFrame:
    """Every raw row with its metrics and the first rule it breaks, written to the scratch folder."""
    path = fresh_dir(raw.sparkSession, "judged-trips")
    return write_judged(add_metrics(raw), [*cleaning(year), *PLAUSIBLE], path)


def steps_of(judged: DataFrame, year: int = YEAR) -> DataFrame:
    return step_counts(all_rows(judged), [*cleaning(year), *PLAUSIBLE])


def clean_steps(raw: DataFrame, year: int = YEAR) -> DataFrame:
    return step_counts(add_metrics(raw), [*cleaning(year), *PLAUSIBLE])


def summary(name: str, fact_rows: DataFrame) -> DataFrame:
    return summarise(fact_rows, SUMMARIES[name])


def checks(fact_rows: DataFrame, year: int = YEAR) -> DataFrame:
    return check_rules(fact_rows, [*CHECKS, out_of_period(year)])


def verdict(fact_rows: DataFrame, year: int = YEAR) -> DataFrame:
    return gate(checks(fact_rows, year))


def report(name: str, fact_rows: DataFrame) -> DataFrame:
    return REPORTS[name].run(fact_rows)


TABLES = (FACT, *SUMMARIES)
LEDGER = "ledger_trips"
REJECTED_TABLE = "rejected_trips"


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Fact and summaries that are live below ``root``."""
    manifest = versions.live(spark, root)
    schemas = {FACT: T.StructType.fromJson(manifest.facts["fact_schema"])} if manifest else {}
    return {name: versions.read(spark, root, name, schemas.get(name), manifest) for name in TABLES}


def run(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    quarantine: bool = False,
    publish_failed: bool = False,
    year: int = YEAR,
) -> DataFrame:
    """Load fact and summaries below ``root`` and return the run's log, one row.

    As for orders, what was live before stays so unless all checks pass or ``publish_failed``.
    """
    clock = StageClock()
    with logged_failure(spark, "trips", clock, root), scratch_scope(spark):
        draft = Draft(spark, root)
        sources = {"trips_raw": raw}
        clock.end("extract")
        judged = judge(raw, year)
        built = _by_month(kept_rows(judged).select(*raw.columns))
        written = {FACT: write_partitioned(built, draft.path(FACT), PARTITIONED_BY, already_spread=True)}
        loaded = versions.read_folders(spark, root, FACT, [draft.folder(FACT)], built.schema)
        clock.end("transform")
        others = {name: summary(name, loaded) for name in SUMMARIES}
        if quarantine:
            others[REJECTED_TABLE] = rejected_rows(judged).select(*raw.columns, "reason")
        went_out = write_tables({draft.path(name): df for name, df in others.items()})
        written |= {name: went_out[draft.path(name)] for name in others}
        folders = {name: [draft.folder(name)] for name in (FACT, *others)}
        clock.end("load")

        back = {name: versions.read_folders(spark, root, name, folders[name]) for name in others}
        back[FACT] = loaded
        # A few rows each: the only data that comes to the driver.
        counted = at_once(
            {
                "audit": rule_counts(all_rows(judged), [ALL_ROWS, *AUDITED, out_of_period(year)]).collect,
                "steps": steps_of(judged, year).collect,
                "tables": verify_tables(back, written).collect,
                "partitions": verify_partitions(loaded, PARTITIONED_BY).first,
                "checks": checks(loaded, year).collect,
            }
        )
        issues = {r["rule"]: r["matches"] for r in counted["audit"]}
        raw_rows = issues.pop(ALL_ROWS.name)
        found = {r["table"]: r for r in counted["tables"]}
        failures = {r["check"]: r["failures"] for r in counted["checks"]}
        failures[ALTERED] = sum(not r["intact"] for r in found.values())
        clock.end("checks")
        publish = publish_failed or not any(failures.values())
        log = run_log(
            spark,
            name="trips",
            failures=failures,
            sources=sources,
            extract={"trips_raw": raw_rows},
            issues=issues,
            steps=counted["steps"],
            last_cleaning_step=TIME_ORDER.name,
            rows_final=found[FACT]["rows"],
            columns_before=len(raw.columns),
            clock=clock,
            fact_path=draft.path(FACT),
            summaries=list(SUMMARIES),
            final_columns=found[FACT]["columns"],
            loaded={f"{name}_rows": found[name]["rows"] for name in TABLES},
            partition_columns=PARTITIONED_BY,
            partitions=counted["partitions"]["partitions"],
            root=root,
            version=draft.number,
            published=publish,
        )
        if publish:
            draft.publish(folders, written=written, fact_schema=json.loads(built.schema.json()))
    append_json(log, f"{root}/run_log")
    return log


def fact_table() -> Fact:
    """What states of the summaries go by; trips have no key to deduplicate on."""
    return Fact(table=FACT, key="", order_by=(), by=PARTITIONED_BY, placed=enrich, join=enrich, complete=lambda rows: rows, summaries=SUMMARIES)


def take_in(
    spark: SparkSession, folder: str, root: str, publish_failed: bool = False, year: int = YEAR
) -> DataFrame:
    """Load the Parquet files below ``folder`` that were not taken in before; returns the log.

    Their rows join the fact, their states those of the summaries, which are merged again, and
    the files the ledger, all in one step. Nothing that was loaded before is read but the
    states. Without new files nothing changes. A file that changed after it was
    taken in is an error. For a folder that only this fills: `run` replaces what it made.
    """
    clock = StageClock()
    with logged_failure(spark, TAKE_IN, clock, root), scratch_scope(spark):
        draft = Draft(spark, root)
        live = draft.before
        before = {k: list(v) for k, v in live.tables.items()} if live else {}
        if live and LEDGER not in before:
            raise versions.NothingPublished(f"what is live at {root} was not loaded file by file")
        ledger = versions.read_folders(spark, root, LEDGER, before.get(LEDGER, []), T.StructType.fromDDL(ledgers.SCHEMA))
        new = ledgers.not_taken_in(ledgers.files_below(spark, folder), ledger)
        # As many paths as there are new files, which the reader needs on the driver anyway.
        files = new.withColumn("loaded_in", F.lit(draft.number).cast("long")).collect()
        clock.end("extract")
        loaded = {"files": len(files), "raw_rows": 0, "fact_rows": 0}
        failures: dict[str, int] = {}
        publish, sources = False, {}
        if files:
            raw = read_parquet(spark, *(ledgers.readable_path(f["path"]) for f in files))
            sources = {"trips_raw": raw}
            judged = judge(raw, year)
            built = _by_month(kept_rows(judged).select(*raw.columns))
            went_out = write_partitioned(built, draft.path(FACT), PARTITIONED_BY, already_spread=True)
            rows = versions.read_folders(spark, root, FACT, [draft.folder(FACT)], built.schema)
            clock.end("transform")
            spec = fact_table()
            schemas = write_states(rows, spec, draft)
            folders = {name: [*before.get(name, []), draft.folder(name)] for name in (FACT, LEDGER, *schemas)}
            write_table(spark.createDataFrame(files, ledgers.SCHEMA).coalesce(1), draft.path(LEDGER))
            write_tables({draft.path(n): df for n, df in merge_summaries(spark, root, spec, folders, schemas).items()})
            folders |= {name: [draft.folder(name)] for name in SUMMARIES}
            clock.end("load")
            failures = {r["check"]: r["failures"] for r in checks(rows, year).collect()}
            back = verify_tables({FACT: rows}, {FACT: went_out}).first()
            failures[ALTERED] = int(not back["intact"])
            loaded |= {"raw_rows": all_rows(judged).count(), "fact_rows": back["rows"]}
            clock.end("checks")
            publish = publish_failed or not any(failures.values())
        log = reload_log(
            spark,
            name=TAKE_IN,
            failures=failures,
            sources=sources,
            loaded=loaded,
            clock=clock,
            root=root,
            version=draft.number,
            published=publish,
        )
        if publish:
            draft.publish(folders, written={}, fact_schema=json.loads(built.schema.json()))
    append_json(log, f"{root}/run_log")
    return log
