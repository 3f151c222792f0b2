"""Queries of the trips domain, and audits that look at both domains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import elapsed_seconds
from millrace.operators import audit
from millrace.operators.clean import reason_counts, require
from millrace.plans import orders, trips
from millrace.session import fresh_dir
from verification import loaded
from verification.duckdb_tables import (
    DISTANCE,
    DURATION,
    FARE,
    REVENUE,
    SPEED,
    TIP_PCT,
    from_both,
    from_trips,
    pct,
)
from verification.registry import query
from verification.stand_ins import raw_orders, raw_trips


def _of(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.lit(name).alias(column), "*")


# --- audit

_ORDER_COLUMNS = (
    "order_id order_date customer_id product_id quantity unit_price discount_pct "
    "payment_method status"
).split()
_TRIP_COLUMNS = (
    "event_id VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance "
    "RatecodeID PULocationID DOLocationID payment_type fare_amount tip_amount total_amount"
).split()


def _null_counts(table: str, columns: list[str]) -> str:
    return "\nunion all\n".join(
        f"""select '{table}' as table_name, '{c}' as column_name,
                   count(*) - count({c}) as null_count,
                   {pct(f"(count(*) - count({c}))", "count(*)", 2)} as null_pct
            from raw_{table}"""
        for c in columns
    )

_ALL_NULLS = (
    _null_counts("orders", _ORDER_COLUMNS) + "\nunion all\n" + _null_counts("trips", _TRIP_COLUMNS)
)


@query(from_both(_ALL_NULLS))
def audit_nulls(spark, sf_dir):
    return _of(audit.null_profile(raw_orders(spark, sf_dir)), "table_name", "orders").unionByName(
        _of(audit.null_profile(raw_trips(spark, sf_dir)), "table_name", "trips")
    )


@query(
    from_both(
        f"""select table_name, cast(sum(null_count) as bigint) as null_cells
            from ({_ALL_NULLS}) group by table_name"""
    )
)
def audit_null_cells(spark, sf_dir):
    return _of(audit.null_cells(raw_orders(spark, sf_dir)), "table_name", "orders").unionByName(
        _of(audit.null_cells(raw_trips(spark, sf_dir)), "table_name", "trips")
    )

_TRIP_RULES = {
    "negative_fares": "fare_amount < 0",
    "zero_fares": "fare_amount = 0",
    "negative_tips": "tip_amount < 0",
    "zero_distance": "trip_distance = 0",
    "non_positive_totals": "total_amount <= 0",
    "fares_over_500": "fare_amount > 500",
    "zero_passengers": "coalesce(passenger_count, 0) = 0",
}


def _rule_rows(rules: dict[str, str]) -> str:
    return ", ".join(
        f"{{'rule': '{name}', 'matches': count(*) filter (where {condition})}}"
        for name, condition in rules.items()
    )


@query(from_trips(f"select unnest([{_rule_rows(_TRIP_RULES)}], recursive := true) from raw_trips"))
def audit_rules_trips(spark, sf_dir):
    return audit.rule_counts(raw_trips(spark, sf_dir), trips.AUDITED)


@query(
    from_trips(
        """select min(tpep_pickup_datetime) as earliest_pickup,
                  max(tpep_pickup_datetime) as latest_pickup,
                  min(tpep_dropoff_datetime) as earliest_dropoff,
                  max(tpep_dropoff_datetime) as latest_dropoff from raw_trips"""
    )
)
def audit_date_range(spark, sf_dir):
    columns = {trips.PICKUP: "pickup", trips.DROPOFF: "dropoff"}
    return audit.value_range(raw_trips(spark, sf_dir), columns)


@query(
    from_trips(
        """select 'wrong_year' as rule,
                  count(*) filter (where year(tpep_pickup_datetime) <> 2024) as matches
           from raw_trips"""
    )
)
def audit_out_of_period(spark, sf_dir):
    return audit.rule_counts(raw_trips(spark, sf_dir), [trips.OUT_OF_PERIOD])


@query(
    from_trips(
        """select 'VendorID' as column_name, cast(VendorID as varchar) as value, count(*) as rows
           from raw_trips group by VendorID
           union all
           select 'payment_type', cast(payment_type as varchar), count(*)
           from raw_trips group by payment_type
           union all
           select 'RatecodeID', cast(RatecodeID as varchar), count(*)
           from raw_trips group by RatecodeID"""
    )
)
def audit_distribution(spark, sf_dir):
    return audit.distribution(raw_trips(spark, sf_dir), trips.CODE_COLUMNS)


@query(
    from_trips(
        f""", flags as (
              select fare_amount < 0 as a, trip_distance = 0 as b, total_amount <= 0 as c,
                     year(tpep_pickup_datetime) <> 2024 as d,
                     coalesce(passenger_count, 0) = 0 as e, fare_amount = 0 as f,
                     tip_amount < 0 as g, fare_amount > 500 as h
              from raw_trips),
            counts as (
              select count(*) as total_rows,
                     count(*) filter (where a) + count(*) filter (where b)
                       + count(*) filter (where c) + count(*) filter (where d)
                       + count(*) filter (where e) as total_issues,
                     count(*) filter (where a or b or c or d or e or f or g or h)
                       as rows_with_issue
              from flags)
            select total_rows, total_issues, {pct("total_issues", "total_rows", 1)} as issue_pct,
                   total_rows - total_issues as clean_rows_estimate, rows_with_issue,
                   total_rows - rows_with_issue as clean_rows from counts"""
    )
)
def audit_summary(spark, sf_dir):
    every_rule = [*trips.AUDITED, trips.OUT_OF_PERIOD]
    return audit.issue_summary(raw_trips(spark, sf_dir), trips.HEADLINE, every_rule)



@query(
    from_trips(
        f"""select 'nulls' as section, column_name as name, cast(null as varchar) as value, null_count as number
            from ({_null_counts("trips", _TRIP_COLUMNS)})
            union all
            select 'rules', rule, null, matches
            from (select unnest([{_rule_rows(_TRIP_RULES | {"wrong_year": "year(tpep_pickup_datetime) <> 2024"})}], recursive := true) from raw_trips)
            union all select 'codes', 'VendorID', cast(VendorID as varchar), count(*) from raw_trips group by VendorID
            union all select 'codes', 'payment_type', cast(payment_type as varchar), count(*) from raw_trips group by payment_type
            union all select 'codes', 'RatecodeID', cast(RatecodeID as varchar), count(*) from raw_trips group by RatecodeID
            union all select 'range', 'earliest_pickup', strftime(min(tpep_pickup_datetime), '%Y-%m-%d %H:%M:%S'), null from raw_trips
            union all select 'range', 'latest_dropoff', strftime(max(tpep_dropoff_datetime), '%Y-%m-%d %H:%M:%S'), null from raw_trips
            union all select 'summary', 'total_rows', null, count(*) from raw_trips
            union all select 'summary', 'rows_with_issue', null,
                count(*) filter (where {" or ".join(f"coalesce({c}, false)" for c in _TRIP_RULES.values())}
                                 or year(tpep_pickup_datetime) <> 2024) from raw_trips"""
    )
)
def audit_profile(spark, sf_dir):
    """Every audit of the raw trips from one aggregate over them, in long form."""
    found = audit.Profile(
        raw_trips(spark, sf_dir),
        fresh_dir(spark, "profile"),
        rules=[*trips.AUDITED, trips.OUT_OF_PERIOD],
        codes=trips.CODE_COLUMNS,
        ranges={trips.PICKUP: "pickup", trips.DROPOFF: "dropoff"},
        any_of=[*trips.AUDITED, trips.OUT_OF_PERIOD],
    )
    no_text, no_number = "cast(null as string) as value", "cast(null as bigint) as number"
    ends = found.value_range()
    stamp = "date_format({}, 'yyyy-MM-dd HH:mm:ss') as value"
    issues = found.issue_summary(trips.HEADLINE)
    parts = [
        found.nulls().selectExpr("'nulls' as section", "column_name as name", no_text, "null_count as number"),
        found.rule_counts().selectExpr("'rules' as section", "rule as name", no_text, "matches as number"),
        found.distribution().selectExpr("'codes' as section", "column_name as name", "value", "rows as number"),
        *(
            ends.selectExpr("'range' as section", f"'{end}' as name", stamp.format(end), no_number)
            for end in ("earliest_pickup", "latest_dropoff")
        ),
        *(
            issues.selectExpr("'summary' as section", f"'{name}' as name", no_text, f"{name} as number")
            for name in ("total_rows", "rows_with_issue")
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- cleaning


@query(
    from_trips(
        """select * from raw_trips where fare_amount > 0 and fare_amount < 500
           and trip_distance > 0 and trip_distance < 200 and total_amount > 0
           and total_amount < 500 and passenger_count between 1 and 6"""
    )
)
def clean_ranges(spark, sf_dir):
    return require(raw_trips(spark, sf_dir), trips.RANGES)


@query(from_trips("select * from raw_trips where year(tpep_pickup_datetime) = 2024"))
def clean_period(spark, sf_dir):
    return require(raw_trips(spark, sf_dir), [trips.IN_PERIOD])


@query(from_trips("select * from raw_trips where tpep_pickup_datetime < tpep_dropoff_datetime"))
def clean_time_order(spark, sf_dir):
    return require(raw_trips(spark, sf_dir), [trips.TIME_ORDER])


@query(from_trips("select event_id, trip_duration_min, speed_mph from trips_fact"))
def clean_derived(spark, sf_dir):
    measured = trips.add_metrics(trips.clean(raw_trips(spark, sf_dir)))
    return require(measured, trips.PLAUSIBLE).select("event_id", "trip_duration_min", "speed_mph")


def _step_rows(domain: str, names: list[str]) -> str:
    """Rows of the step table from columns n0, n1, ... of ``<domain>_n``."""
    steps = [(i, name, i - 1, i) for i, name in enumerate(names, 1)]
    steps.append((len(names) + 1, "all", 0, len(names)))
    return "\nunion all\n".join(
        f"""select '{domain}' as domain, cast({no} as int) as step_no, '{name}' as step,
                   n{a} as rows_before, n{b} as rows_after, n{a} - n{b} as rows_removed,
                   {pct(f"(n{a} - n{b})", f"n{a}", 1)} as removed_pct from {domain}_n"""
        for no, name, a, b in steps
    )


@query(
    from_both(
        f"""
        , orders_n as (
          select (select count(*) from raw_orders) as n0, count(*) as n1,
                 count(*) filter (where order_id is not null) as n2,
                 count(*) filter (where order_id is not null and unit_price > 0) as n3,
                 count(*) filter (where order_id is not null and unit_price > 0
                                  and quantity > 0) as n4,
                 (select count(*) from clean_orders) as n5
          from survivors),
        step_flags as (
          select fare_amount > 0 and fare_amount < 500 as a,
                 a and trip_distance > 0 and trip_distance < 200 as b,
                 b and total_amount > 0 and total_amount < 500 as c,
                 c and passenger_count > 0 and passenger_count <= 6 as d,
                 d and (tip_amount is null or isfinite(tip_amount)) as i,
                 i and year(tpep_pickup_datetime) = 2024 as e,
                 e and tpep_pickup_datetime < tpep_dropoff_datetime as f,
                 f and trip_duration_min > 1 and trip_duration_min < 180 as g,
                 g and (speed_mph is null or speed_mph < 80) as h
          from metrics),
        trips_n as (
          select count(*) as n0, count(*) filter (where a) as n1, count(*) filter (where b) as n2,
                 count(*) filter (where c) as n3, count(*) filter (where d) as n4,
                 count(*) filter (where i) as n5, count(*) filter (where e) as n6,
                 count(*) filter (where f) as n7, count(*) filter (where g) as n8,
                 count(*) filter (where h) as n9
          from step_flags)
        {_step_rows("orders", ["duplicate_key", "order_id_missing", "unit_price_not_positive",
                               "quantity_not_positive", "customer_id_missing"])}
        union all
        {_step_rows("trips", ["fare_out_of_range", "distance_out_of_range", "total_out_of_range",
                              "passengers_out_of_range", "tip_not_finite", "outside_period", "not_in_time_order",
                              "duration_implausible", "speed_implausible"])}"""
    )
)
def clean_stats(spark, sf_dir):
    """Rows before, after and removed, step by step and in all."""
    return _of(orders.clean_steps(raw_orders(spark, sf_dir)), "domain", "orders").unionByName(
        _of(trips.clean_steps(raw_trips(spark, sf_dir)), "domain", "trips")
    )


@query(from_trips("select * from rejected_trips"))
def quarantine_rows_trips(spark, sf_dir):
    return trips.rejected(raw_trips(spark, sf_dir))


@query(
    from_both(
        """select 'orders' as domain, reason, count(*) as rows from rejected_orders group by reason
           union all
           select 'trips', reason, count(*) from rejected_trips group by reason"""
    )
)
def quarantine_counts(spark, sf_dir):
    parts = {
        "orders": orders.rejected(raw_orders(spark, sf_dir)),
        "trips": trips.rejected(raw_trips(spark, sf_dir)),
    }
    counted = [_of(reason_counts(rows), "domain", name) for name, rows in parts.items()]
    return reduce(DataFrame.unionByName, counted)


# --- scalar functions and enrichment


@query(
    from_trips(
        """select event_id, PULocationID in (132, 138) as pickup_at_airport,
                  passenger_count in (1, 2) as small_party from raw_trips"""
    )
)
def fn_isin(spark, sf_dir):
    return raw_trips(spark, sf_dir).select(
        "event_id",
        F.col("PULocationID").isin(*trips.AIRPORT_ZONES).alias("pickup_at_airport"),
        F.col("passenger_count").isin(1, 2).alias("small_party"),
    )


@query(
    from_trips(
        """select event_id, fare_amount between 10 and 25 as mid_fare,
                  passenger_count between 1 and 6 as seats_ok from raw_trips"""
    )
)
def fn_between(spark, sf_dir):
    return raw_trips(spark, sf_dir).select(
        "event_id",
        F.col("fare_amount").between(10, 25).alias("mid_fare"),
        F.col("passenger_count").between(1, 6).alias("seats_ok"),
    )


@query(
    from_trips(
        """select event_id, cast(floor(epoch(tpep_dropoff_datetime)) as bigint)
                  - cast(floor(epoch(tpep_pickup_datetime)) as bigint) as seconds from raw_trips"""
    )
)
def fn_elapsed(spark, sf_dir):
    seconds = elapsed_seconds(trips.PICKUP, trips.DROPOFF)
    return raw_trips(spark, sf_dir).select("event_id", seconds.alias("seconds"))


@query(
    from_trips(
        "select event_id, trip_duration_min, speed_mph, tip_pct, cost_per_mile from metrics"
    )
)
def enrich_trips_metrics(spark, sf_dir):
    """On unfiltered rows, so that the null and zero branches occur."""
    return trips.add_metrics(raw_trips(spark, sf_dir)).select(
        "event_id", "trip_duration_min", "speed_mph", "tip_pct", "cost_per_mile"
    )


@query(
    from_trips(
        """select event_id, pickup_hour, pickup_date, pickup_month, pickup_day_of_week, day_name,
                  time_of_day, is_rush_hour from calendar"""
    )
)
def enrich_trips_calendar(spark, sf_dir):
    return trips.add_calendar(raw_trips(spark, sf_dir)).select(
        "event_id",
        "pickup_hour",
        "pickup_date",
        "pickup_month",
        "pickup_day_of_week",
        "day_name",
        "time_of_day",
        "is_rush_hour",
    )


@query(
    from_trips(
        "select event_id, is_airport, payment_name, fare_bucket, distance_bucket from labelled"
    )
)
def enrich_trips_labels(spark, sf_dir):
    return trips.add_labels(raw_trips(spark, sf_dir)).select(
        "event_id", "is_airport", "payment_name", "fare_bucket", "distance_bucket"
    )


@query(from_trips("select * from trips_fact"))
def enrich_trips(spark, sf_dir):
    return trips.fact(raw_trips(spark, sf_dir))


# --- aggregates over the loaded fact


@query(from_trips("select * from agg_daily_trips"))
def agg_daily_trips(spark, sf_dir):
    return trips.summary("agg_daily", loaded.fact_trips(spark, sf_dir))


@query(from_trips("select * from agg_hourly_trips"))
def agg_hourly_trips(spark, sf_dir):
    return trips.summary("agg_hourly", loaded.fact_trips(spark, sf_dir))


@query(from_trips("select * from agg_zone_trips"))
def agg_zone_trips(spark, sf_dir):
    return trips.summary("agg_zones", loaded.fact_trips(spark, sf_dir))


@query(from_trips("select * from agg_payment_trips"))
def agg_payment_trips(spark, sf_dir):
    return trips.summary("agg_payment", loaded.fact_trips(spark, sf_dir))


# --- reports


@query(
    from_trips(
        f"""select pickup_month, count(*) as trips, {REVENUE} as revenue, {FARE} as avg_fare,
                   {DISTANCE} as avg_distance, {TIP_PCT} as avg_tip_pct
            from trips_fact group by pickup_month"""
    )
)
def sql_trips_monthly(spark, sf_dir):
    return trips.report("monthly", loaded.fact_trips(spark, sf_dir))


@query(
    from_trips(
        f"""select is_rush_hour, count(*) as trips, {FARE} as avg_fare,
                   {DURATION} as avg_duration, {SPEED} as avg_speed
            from trips_fact where speed_mph is not null group by is_rush_hour"""
    )
)
def sql_trips_rush(spark, sf_dir):
    return trips.report("rush", loaded.fact_trips(spark, sf_dir))


@query(
    from_trips(
        f"""select is_airport, count(*) as trips, {FARE} as avg_fare,
                   {DISTANCE} as avg_distance, {TIP_PCT} as avg_tip_pct
            from trips_fact group by is_airport"""
    )
)
def sql_trips_airport(spark, sf_dir):
    return trips.report("airport", loaded.fact_trips(spark, sf_dir))


@query(
    from_trips(
        f"""select fare_bucket, count(*) as trips, {REVENUE} as total_revenue,
                   {DISTANCE} as avg_distance
            from trips_fact group by fare_bucket"""
    )
)
def sql_trips_fare_bucket(spark, sf_dir):
    return trips.report("fare_bucket", loaded.fact_trips(spark, sf_dir))


@query(
    from_trips(
        f"""select day_name, pickup_day_of_week, count(*) as trips, {FARE} as avg_fare,
                   {REVENUE} as total_revenue
            from trips_fact group by day_name, pickup_day_of_week"""
    )
)
def sql_trips_dow(spark, sf_dir):
    return trips.report("dow", loaded.fact_trips(spark, sf_dir))


# --- checks

_VERDICT = "case when failures = 0 then 'PASS' else 'FAIL' end as verdict"


@query(from_trips(f"select *, {_VERDICT} from trip_checks"))
def check_trips(spark, sf_dir):
    return trips.checks(loaded.fact_trips(spark, sf_dir))


def _gate(domain: str, checks: str) -> str:
    return f"""select '{domain}' as domain, count(*) as checks,
                      cast(coalesce(sum(failures), 0) as bigint) as failures,
                      case when coalesce(sum(failures), 0) = 0 then 'SUCCESS' else 'FAILED' end
                          as status from {checks}"""


@query(
    from_both(f'{_gate("orders", "order_checks")} union all {_gate("trips", "trip_checks")}')
)
def check_gate(spark, sf_dir):
    return _of(orders.verdict(loaded.fact_orders(spark, sf_dir)), "domain", "orders").unionByName(
        _of(trips.verdict(loaded.fact_trips(spark, sf_dir)), "domain", "trips")
    )
