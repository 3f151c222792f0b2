"""Sources, sinks, verification of outputs and the run log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.reuse import reused
from millrace.operators.rules import Rule
from millrace.operators.summaries import distinct_values, merged, partial_states, summarise
from millrace.plans import orders, trips
from millrace.plans.runlog import log_entries, log_steps, read_log
from millrace.session import fresh_dir
from millrace.sources import storage, versions, writers
from millrace.sources.readers import read_csv, read_json, read_parquet, source_summary
from millrace.sources.schemas import CORRUPT_RECORD, CUSTOMERS, PRODUCTS, RAW_ORDERS
from verification import loaded, stand_ins
from verification.duckdb_tables import from_both, from_orders, from_trips
from verification.registry import ORACLES, query
from verification.trips_queries import clean_stats  # noqa: F401  its oracle is used below

# --- sources


def _write_orders_csv(spark, sf_dir) -> str:
    """Raw orders as CSV, with text in some cells of a number column."""
    path = fresh_dir(spark, "orders-csv")
    quantity = F.when(F.col("order_id") % 701 == 0, "n/a").otherwise(
        F.col("quantity").cast("string")
    )
    raw = stand_ins.raw_orders(spark, sf_dir).withColumn("quantity", quantity)
    raw.write.option("header", True).csv(path)
    return path


@query(
    from_orders(
        """select * replace (case when order_id % 701 = 0 then null else quantity end as quantity),
                  order_id % 701 = 0 as has_bad_cell from raw_orders"""
    )
)
def src_csv_schema(spark, sf_dir):
    path = _write_orders_csv(spark, sf_dir)
    df = read_csv(spark, path, schema=RAW_ORDERS, keep_corrupt=True)
    return df.withColumn("has_bad_cell", F.col(CORRUPT_RECORD).isNotNull()).drop(CORRUPT_RECORD)


@query(
    from_orders(
        """select * exclude (bad)
                  replace (case when bad then null else quantity end as quantity,
                           case when bad then 'cell_unreadable' else reason end as reason)
           from (select *, order_id % 701 = 0 as bad from judged_orders)
           where bad or reason is not null"""
    )
)
def quarantine_corrupt(spark, sf_dir):
    """Rejected lines of a CSV file, those with an unreadable cell among them."""
    path = _write_orders_csv(spark, sf_dir)
    raw = read_csv(spark, path, schema=RAW_ORDERS, keep_corrupt=True)
    return orders.rejected(raw).drop(CORRUPT_RECORD)


@query(from_orders("select * from products"))
def src_json(spark, sf_dir):
    path = fresh_dir(spark, "products-json")
    stand_ins.products(spark, sf_dir).write.json(path)
    return read_json(spark, path, schema=PRODUCTS)


@query(from_orders("select * from customers"))
def src_csv_infer(spark, sf_dir):
    path = fresh_dir(spark, "customers-csv")
    stand_ins.customers(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv(spark, path)


def _write_trip_months(spark, sf_dir) -> list[str]:
    """Raw trips as one Parquet folder per pickup month."""
    path = fresh_dir(spark, "trip-months")
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    raw = stand_ins.raw_trips(spark, sf_dir).withColumn("source_month", month)
    writers.write_partitioned(raw, path, ["source_month"])
    return storage.child_folders(spark, path)


@query(from_trips("select * from raw_trips"))
def src_parquet_multi(spark, sf_dir):
    return read_parquet(spark, *_write_trip_months(spark, sf_dir))


@query(from_orders("select * from orders_fact"))
def src_parquet_partitioned(spark, sf_dir):
    """Partition columns come back from the folder names, as the last columns."""
    return loaded.fact_orders(spark, sf_dir)


@query(
    from_both(
        """, s as (
             select 'orders' as source, count(*) as rows, 9 as columns, 3 as files from raw_orders
             union all select 'products', count(*), 7, 2 from products
             union all select 'customers', count(*), 7, 1 from customers
             union all
             select 'trips', count(*), 13,
                    count(distinct strftime(tpep_pickup_datetime, '%Y-%m')) from raw_trips)
           select source, rows, cast(columns as bigint) as columns, cast(files as bigint) as files
           from s
           union all
           select 'total', cast(sum(rows) as bigint), cast(sum(columns) as bigint),
                  cast(sum(files) as bigint) from s"""
    )
)
def extract_summary(spark, sf_dir):
    at = {name: fresh_dir(spark, f"summary-{name}") for name in ("orders", "products", "customers")}
    stand_ins.raw_orders(spark, sf_dir).repartition(3).write.option("header", True).csv(at["orders"])
    stand_ins.products(spark, sf_dir).repartition(2).write.json(at["products"])
    stand_ins.customers(spark, sf_dir).coalesce(1).write.option("header", True).csv(at["customers"])
    sources = {
        "orders": read_csv(spark, at["orders"], schema=RAW_ORDERS),
        "products": read_json(spark, at["products"], schema=PRODUCTS),
        "customers": read_csv(spark, at["customers"], schema=CUSTOMERS),
        "trips": read_parquet(spark, *_write_trip_months(spark, sf_dir)),
    }
    return source_summary(sources)


# --- sinks


@query(from_orders("select * from orders_fact"))
def sink_fact_orders(spark, sf_dir):
    return orders.write_fact(
        stand_ins.raw_orders(spark, sf_dir),
        stand_ins.products(spark, sf_dir),
        stand_ins.customers(spark, sf_dir),
        fresh_dir(spark, "fact-orders"),
    )


@query(from_trips("select * from trips_fact"))
def sink_fact_trips(spark, sf_dir):
    return trips.write_fact(stand_ins.raw_trips(spark, sf_dir), fresh_dir(spark, "fact-trips"))


@query(
    from_orders(
        """select product_id as id, * exclude (product_id), null::varchar as customer_name,
                  null::varchar as city, null::varchar as country,
                  null::varchar as customer_segment, null::varchar as email,
                  null::date as signup_date from products
           union all by name
           select cast(customer_id as bigint) as id, * exclude (customer_id) from customers"""
    )
)
def sink_dims(spark, sf_dir):
    """Every column of both dimensions, as read back."""
    root = fresh_dir(spark, "dims")
    dims = {
        f"{root}/products": stand_ins.products(spark, sf_dir),
        f"{root}/customers": stand_ins.customers(spark, sf_dir),
    }
    writers.write_tables(dims)
    products, customers = (read_parquet(spark, path) for path in dims)
    by_id = customers.withColumn("id", F.col("customer_id").cast("bigint")).drop("customer_id")
    return products.withColumnRenamed("product_id", "id").unionByName(
        by_id, allowMissingColumns=True
    )


# Summary table -> the column that counts fact rows.
_COUNTED = {
    "agg_daily_summary": "total_orders",
    "agg_category_summary": "orders",
    "agg_daily": "total_trips",
    "agg_hourly": "trips",
    "agg_zones": "trips",
    "agg_payment": "trips",
}


def _control_sums(spark, paths: dict[str, str]) -> DataFrame:
    """(summary, groups, fact_rows) of written summary tables."""
    parts = [
        read_parquet(spark, path)
        .agg(F.count(F.lit(1)).alias("groups"), F.sum(_COUNTED[name]).alias("fact_rows"))
        .select(F.lit(name).alias("summary"), "groups", "fact_rows")
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_TRIP_SUMS = """
    select 'agg_daily' as summary, count(*) as groups,
           cast(sum(total_trips) as bigint) as fact_rows from agg_daily_trips
    union all select 'agg_hourly', count(*), cast(sum(trips) as bigint) from agg_hourly_trips
    union all select 'agg_zones', count(*), cast(sum(trips) as bigint) from agg_zone_trips
    union all select 'agg_payment', count(*), cast(sum(trips) as bigint) from agg_payment_trips"""


@query(
    from_both(
        f"""{_TRIP_SUMS}
            union all select 'agg_daily_summary', count(*), cast(sum(total_orders) as bigint)
            from agg_daily_orders
            union all select 'agg_category_summary', count(*), cast(sum(orders) as bigint)
            from agg_category_orders"""
    )
)
def sink_summaries(spark, sf_dir):
    root = fresh_dir(spark, "summaries")
    facts = (
        (loaded.fact_orders(spark, sf_dir), orders.SUMMARIES),
        (loaded.fact_trips(spark, sf_dir), trips.SUMMARIES),
    )
    tables = {name: summarise(fact, spec) for fact, specs in facts for name, spec in specs.items()}
    paths = {name: f"{root}/{name}" for name in tables}
    writers.write_tables({paths[name]: df for name, df in tables.items()})
    return _control_sums(spark, paths)


@query(from_trips(_TRIP_SUMS))
def reuse_cached(spark, sf_dir):
    """Four summaries from one computation of the fact, without writing it."""
    root = fresh_dir(spark, "from-cache")
    paths = {name: f"{root}/{name}" for name in trips.SUMMARIES}
    with reused(trips.fact(stand_ins.raw_trips(spark, sf_dir))) as fact:
        # One after the other: the first fills the cache for the rest.
        for name, path in paths.items():
            writers.write_table(trips.summary(name, fact), path)
    return _control_sums(spark, paths)


# --- verification and log

_WRITTEN = """
    select 'fact_orders' as "table", count(*) as rows, 31 as columns from orders_fact
    union all select 'dim_products', count(*), 7 from products
    union all select 'dim_customers', count(*), 7 from customers
    union all select 'agg_daily_summary', count(*), 7 from agg_daily_orders
    union all select 'agg_category_summary', count(*), 7 from agg_category_orders
    union all select 'fact_trips', count(*), 28 from trips_fact
    union all select 'agg_daily', count(*), 12 from agg_daily_trips
    union all select 'agg_hourly', count(*), 7 from agg_hourly_trips
    union all select 'agg_zones', count(*), 6 from agg_zone_trips
    union all select 'agg_payment', count(*), 5 from agg_payment_trips"""


@query(from_both(f"""select *, true as intact from ({_WRITTEN})"""))
def verify_outputs(spark, sf_dir):
    """Rows and columns of every table read back, and whether its checksum is that of what went out."""
    parts = [
        writers.verify_tables(domain.tables(spark, root), versions.live(spark, root).facts["written"])
        for domain, root in (
            (orders, loaded.orders_root(spark, sf_dir)),
            (trips, loaded.trips_root(spark, sf_dir)),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    from_both(
        """select 'fact_orders' as "table",
                  count(distinct order_year * 100 + order_month) as partitions,
                  cast(0 as bigint) as null_partitions from orders_fact
           union all
           select 'fact_trips', count(distinct pickup_month), 0 from trips_fact"""
    )
)
def verify_partitions(spark, sf_dir):
    facts = {
        orders.FACT: (loaded.fact_orders(spark, sf_dir), orders.PARTITIONED_BY),
        trips.FACT: (loaded.fact_trips(spark, sf_dir), trips.PARTITIONED_BY),
    }
    parts = [
        writers.verify_partitions(fact, by).select(
            F.lit(name).alias("table"), "partitions", "null_partitions"
        )
        for name, (fact, by) in facts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_LOG = f"""
, written as ({_WRITTEN}),
entries as (
  select 'orders' as pipeline_name, 'extract' as section, 'orders_raw' as entry,
         count(*) as value from raw_orders
  union all select 'orders', 'extract', 'products_raw', count(*) from products
  union all select 'orders', 'extract', 'customers_raw', count(*) from customers
  union all select 'orders', 'transform', 'rows_before_cleaning', count(*) from raw_orders
  union all select 'orders', 'transform', 'rows_after_cleaning', count(*) from clean_orders
  union all select 'orders', 'transform', 'rows_after_filters', count(*) from clean_orders
  union all select 'orders', 'transform', 'columns_added', 22
  union all select 'orders', 'transform', 'rows_removed', count(*) from rejected_orders
  union all select 'orders', 'transform', 'final_columns', 31
  union all select 'orders', 'issues', 'negative_price', count(*) from raw_orders
            where unit_price < 0
  union all select 'orders', 'issues', 'non_positive_quantity', count(*) from raw_orders
            where quantity <= 0
  union all select 'orders', 'load', "table" || '_rows', rows from written
            where "table" in ('fact_orders', 'dim_products', 'dim_customers',
                              'agg_daily_summary', 'agg_category_summary')
  union all select 'orders', 'partitions', 'partitions',
            count(distinct order_year * 100 + order_month) from orders_fact
  union all select 'orders', 'checks', "check", failures from order_checks
  union all select 'orders', 'checks', 'tables_altered', 0
  union all select 'trips', 'checks', 'tables_altered', 0
  union all select 'trips', 'extract', 'trips_raw', count(*) from raw_trips
  union all select 'orders', 'extract_columns', 'orders_raw', 9
  union all select 'orders', 'extract_columns', 'products_raw', 7
  union all select 'orders', 'extract_columns', 'customers_raw', 7
  union all select 'trips', 'extract_columns', 'trips_raw', 13
  union all select 'trips', 'transform', 'rows_before_cleaning', count(*) from raw_trips
  union all select 'trips', 'transform', 'rows_after_cleaning', count(*) from clean_trips
  union all select 'trips', 'transform', 'rows_after_filters', count(*) from trips_fact
  union all select 'trips', 'transform', 'columns_added', 15
  union all select 'trips', 'transform', 'rows_removed', count(*) from rejected_trips
  union all select 'trips', 'transform', 'final_columns', 28
  union all select 'trips', 'issues', 'negative_fares', count(*) from raw_trips
            where fare_amount < 0
  union all select 'trips', 'issues', 'zero_fares', count(*) from raw_trips where fare_amount = 0
  union all select 'trips', 'issues', 'negative_tips', count(*) from raw_trips where tip_amount < 0
  union all select 'trips', 'issues', 'zero_distance', count(*) from raw_trips
            where trip_distance = 0
  union all select 'trips', 'issues', 'non_positive_totals', count(*) from raw_trips
            where total_amount <= 0
  union all select 'trips', 'issues', 'fares_over_500', count(*) from raw_trips
            where fare_amount > 500
  union all select 'trips', 'issues', 'zero_passengers', count(*) from raw_trips
            where coalesce(passenger_count, 0) = 0
  union all select 'trips', 'issues', 'wrong_year', count(*) from raw_trips
            where year(tpep_pickup_datetime) <> 2024
  union all select 'trips', 'load', "table" || '_rows', rows from written
            where "table" in ('fact_trips', 'agg_daily', 'agg_hourly', 'agg_zones', 'agg_payment')
  union all select 'trips', 'partitions', 'partitions', count(distinct pickup_month)
            from trips_fact
  union all select 'trips', 'checks', "check", failures from trip_checks)
select *, case when sum(case when section = 'checks' then value else 0 end)
                    over (partition by pipeline_name) = 0
               then 'SUCCESS' else 'FAILED' end as status
from entries
"""


@query(from_both(_LOG))
def run_log(spark, sf_dir):
    """Both logs, read back from JSON, in long form and without times and paths."""
    roots = (loaded.orders_root(spark, sf_dir), loaded.trips_root(spark, sf_dir))
    logs = [log_entries(read_log(spark, f"{root}/run_log")) for root in roots]
    return reduce(DataFrame.unionByName, logs)


@query(f"select domain as pipeline_name, * exclude (domain) from ({ORACLES['clean_stats']})")
def run_log_steps(spark, sf_dir):
    """The steps of both runs, with rows before, after and removed, as the logs hold them."""
    roots = (loaded.orders_root(spark, sf_dir), loaded.trips_root(spark, sf_dir))
    logs = [log_steps(read_log(spark, f"{root}/run_log")) for root in roots]
    return reduce(DataFrame.unionByName, logs)


# --- new rows and new files

_LATE = "order_date >= timestamp_ntz'2000-01-01'"


def _reloaded(spark, sf_dir) -> str:
    """A star schema loaded from the rows before a cut-off, with the rest folded in; its folder."""
    # Load and reload read files that have come, as a load does, rather than each join the driver tables anew.
    made, source = stand_ins.raw_orders(spark, sf_dir), fresh_dir(spark, "incoming-orders")
    made.write.option("compression", "zstd").parquet(source)
    raw = read_parquet(spark, source, schema=made.schema)
    dims = stand_ins.products(spark, sf_dir), stand_ins.customers(spark, sf_dir)
    root = fresh_dir(spark, "orders-reloaded")
    late = Rule("late", _LATE)
    orders.run(spark, raw.filter(~late.holds()), *dims, root, reloadable=True, publish_failed=True)
    orders.reload(spark, raw.filter(late.column()), *dims, root, publish_failed=True)
    return root


@query(from_orders("select * from orders_fact"))
def incremental_reload(spark, sf_dir):
    """The fact after a reload is that of a full load of all rows."""
    return orders.tables(spark, _reloaded(spark, sf_dir))[orders.FACT]


@query(
    from_orders(
        """select 'daily' as summary, cast(date as varchar) as group_name, cast(null as int) as month, total_orders as orders,
                  total_revenue as revenue, total_profit as profit, avg_order_value as average,
                  unique_customers, weekend_orders from agg_daily_orders
           union all
           select 'category', category, order_month, orders, revenue, profit, avg_margin,
                  unique_customers, null from agg_category_orders"""
    )
)
def reload_summaries(spark, sf_dir):
    """Both summaries after a reload, merged from states; distinct customers are exact."""
    tables = orders.tables(spark, _reloaded(spark, sf_dir))
    daily = tables["agg_daily_summary"].selectExpr(
        "'daily' as summary", "cast(date as string) as group_name", "cast(null as int) as month", "total_orders as orders",
        "total_revenue as revenue", "total_profit as profit", "avg_order_value as average",
        "unique_customers", "weekend_orders",
    )
    category = tables["agg_category_summary"].selectExpr(
        "'category' as summary", "category as group_name", "order_month as month", "orders", "revenue", "profit",
        "avg_margin as average", "unique_customers", "cast(null as bigint) as weekend_orders",
    )
    return daily.unionByName(category)


@query(
    from_orders(
        """select category, order_month, unique_customers as exact, true as within_error from agg_category_orders"""
    )
)
def agg_approx_distinct(spark, sf_dir):
    """Customers per category and month from sketches kept per fact partition, beside the exact count.

    Twelve bits of registers have a standard error of 1.6 %; four of those are allowed here.
    """
    fact = loaded.fact_orders(spark, sf_dir)
    spec = orders.CATEGORY_MONTH.approximate(lg_registers=12)
    path = fresh_dir(spark, "sketches")
    writers.write_partitioned(partial_states(fact, spec, orders.PARTITIONED_BY), path, ["by_order_year", "by_order_month"])
    sketched = merged(read_parquet(spark, path), distinct_values(fact, spec, orders.PARTITIONED_BY), spec)
    exact = summarise(fact, orders.CATEGORY_MONTH).selectExpr("category as c", "order_month as m", "unique_customers as exact")
    both = exact.join(sketched, F.col("c").eqNullSafe(F.col("category")) & (F.col("m") == F.col("order_month")))
    off = F.abs(F.col("unique_customers") - F.col("exact"))
    within = off <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("exact"))
    return both.select("category", "order_month", "exact", within.alias("within_error"))


def _taken_in(spark, sf_dir) -> tuple[str, list[DataFrame]]:
    """Trips from files that come in two lots, and a third time without new ones; folder and logs."""
    source, root = fresh_dir(spark, "incoming"), fresh_dir(spark, "trips-taken-in")
    raw = stand_ins.raw_trips(spark, sf_dir)
    late = Rule("late", "month(tpep_pickup_datetime) >= 2")
    logs = []
    for lot in (raw.filter(~late.holds()), raw.filter(late.column())):
        month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
        writers.spread(lot.withColumn("source_month", month), "source_month").write.mode("append").partitionBy(
            "source_month"
        ).parquet(source)
        logs.append(trips.take_in(spark, source, root, publish_failed=True))
    logs.append(trips.take_in(spark, source, root, publish_failed=True))
    return root, logs


@query(from_trips("select * from trips_fact"))
def files_taken_in(spark, sf_dir):
    """The fact loaded file by file in two steps is that of one load."""
    root, _ = _taken_in(spark, sf_dir)
    return trips.tables(spark, root)[trips.FACT]


@query(
    from_both(
        """select 1 as load, count(*) as raw_rows from raw_trips
           where not coalesce(month(tpep_pickup_datetime) >= 2, false)
           union all
           select 2, count(*) from raw_trips where month(tpep_pickup_datetime) >= 2
           union all select 3, 0"""
    )
)
def files_loaded_once(spark, sf_dir):
    """Rows that each of three loads of a growing folder took in; the third finds nothing new."""
    _, logs = _taken_in(spark, sf_dir)
    counted = [
        log.select(F.lit(i).alias("load"), F.col("load.rows")["raw_rows"].alias("raw_rows")) for i, log in enumerate(logs, 1)
    ]
    return reduce(DataFrame.unionByName, counted)


@query(from_trips(_TRIP_SUMS))
def files_summaries(spark, sf_dir):
    """Groups and trips in the four summaries, merged from the states of both lots of files."""
    root, _ = _taken_in(spark, sf_dir)
    folders = versions.live(spark, root).tables
    return _control_sums(spark, {name: f"{root}/{folders[name][0]}" for name in trips.SUMMARIES})
