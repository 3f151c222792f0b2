"""Raw tables of the two domains, derived from the driver tables.

The driver tables are clean, so dirt is put in with arithmetic that Spark and
DuckDB compute alike. Whole tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with missing, negative and zero values and repeated ids."""
    lines = table(spark, sf_dir, "lineitem")
    heads = table(spark, sf_dir, "orders")
    rows = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey * 10 + l_linenumber as order_id",
        "timestampadd(HOUR, l_linenumber * 3, o_orderdate) as order_date",
        # Keys that no dimension has, so that there are orphans.
        """case when l_orderkey % 50 = 0 then null when l_orderkey % 97 = 5 then -1.0D * o_custkey
                else cast(o_custkey as double) end as customer_id""",
        "if(l_orderkey % 101 = 7, -l_partkey, l_partkey) as product_id",
        "if(l_suppkey % 37 = 0, 0, cast(l_quantity as int)) as quantity",
        """case when (l_orderkey + l_partkey) % 33 = 0 then null
                when (l_orderkey + l_suppkey) % 997 = 0 then -l_extendedprice
                when l_partkey % 5 = 0 then l_extendedprice / 10000
                else l_extendedprice / 100 end as unit_price""",
        "cast(floor(l_discount * 100 + 0.5D) as int) as discount_pct",
        "o_orderpriority as payment_method",
        """case when l_returnflag = 'R' and l_suppkey % 2 = 0 then 'Returned'
                when l_suppkey % 19 = 1 then 'Cancelled'
                when l_suppkey % 23 = 2 then 'Pending'
                else 'Completed' end as status""",
    )
    # Exact copies of some rows, made in place so that the join runs once.
    copies = F.when(F.col("order_id") % 2500 == 1, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return rows.withColumn("copy", F.explode(copies)).drop("copy")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .selectExpr(
            "p_partkey as product_id",
            "p_name as product_name",
            "p_type as category",
            "p_brand as brand",
            "p_retailprice / 2 as cost_price",
            "p_size % 20 <> 0 as is_active",
            "p_size / 10.0D as weight_kg",
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .selectExpr(
            "cast(c_custkey as int) as customer_id",
            "c_name as customer_name",
            "case c_nationkey % 3 when 0 then 'North' when 1 then 'South' else 'West' end as city",
            "if(c_nationkey < 15, 'USA', 'India') as country",
            "c_mktsegment as customer_segment",
            "if(c_custkey % 13 = 0, null, concat('c', c_custkey, '@example.com')) as email",
            "date_add(date'2019-01-01', cast(c_custkey % 1500 as int)) as signup_date",
        )
    )


def in_user_time_ranges(events: DataFrame) -> DataFrame:
    """Cut events into ranges of (user, time, id), numbered in that order by ``lane``.

    The id is unique, so ranges are of even size, however many events one user
    has, or has at one time.
    """
    ranged = events.repartitionByRange("user_id", "ts", "event_id")
    return ranged.withColumn("lane", F.spark_partition_id())


def with_next_time(events: DataFrame) -> DataFrame:
    """Replace ``lane`` by ``next_ts``, the time of the user's next event.

    A window over the user alone would put a hot user into one task. Here one
    window looks within a user's rows of a range. The other joins up the ranges:
    it ranks only the rows at their edges, two per user and range at most.
    """
    order = ("ts", "event_id")
    within = Window.partitionBy("user_id", "lane").orderBy(*order)
    across = Window.partitionBy("user_id", "edge_lane").orderBy(*order)
    found = events.withColumns(
        {
            "next_here": F.lead("ts").over(within),
            "is_first": F.row_number().over(within) == 1,
        }
    )
    at_edge = F.col("is_first") | F.col("next_here").isNull()
    return (
        found.withColumn("edge_lane", F.when(~at_edge, F.col("lane")))
        .withColumn("next_ts", F.coalesce("next_here", F.lead("ts").over(across)))
        .drop("lane", "next_here", "is_first", "edge_lane")
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip is one event of a user; it ends at the user's next event."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts", "props")
    # The text is read only now, because finding the ranges reads their input twice.
    ranged = in_user_time_ranges(events).selectExpr(
        "event_id",
        "user_id",
        "value",
        "ts",
        "lane",
        "cast(get_json_object(props, '$.k') as int) as k",
        "cast(if(event_id % 61 = 0, -400, (event_id % 3) * 31) as int) as shift_days",
    )
    e = with_next_time(ranged)
    return e.selectExpr(
        "event_id",
        "cast(1 + event_id % 2 as int) as VendorID",
        "timestampadd(DAY, shift_days, ts) as tpep_pickup_datetime",
        "timestampadd(DAY, shift_days, next_ts) as tpep_dropoff_datetime",
        "if(event_id % 41 = 0, null, event_id % 8) as passenger_count",
        "k / 5.0D as trip_distance",
        "1 + event_id % 6 as RatecodeID",
        "100 + user_id % 60 as PULocationID",
        "100 + event_id % 60 as DOLocationID",
        "event_id % 6 as payment_type",
        """case when event_id % 53 = 0 then -value when event_id % 71 = 0 then 0.0D
                else value end as fare_amount""",
        """if(event_id % 97 = 0, -1.0D, value * (event_id % 30) / 100.0D) as tip_amount""",
        "value * 1.5D as total_amount",
    )
