import pytest
from conftest import final_plan, plan, rows
from pyspark.sql import functions as F

from millrace.operators.clean import keep_one
from millrace.operators.dims import (
    DuplicateKeyError,
    hot_keys,
    lookup,
    lookup_hot,
    orphan_counts,
    orphans,
    require_unique,
)
from millrace.plans import orders
from verification import stand_ins


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (2, 30), (9, 40)], "k int, v int")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], "k int, name string, x int")


def test_lookup_keeps_unmatched_rows_and_prunes(facts, dim):
    joined = lookup(facts, dim, "k", ["name"])
    assert joined.columns == ["k", "v", "name"]
    assert rows(joined) == [(1, 10, "a"), (2, 20, "b"), (2, 30, "b"), (9, 40, None)]


def test_duplicate_dimension_key_is_refused(spark, dim):
    require_unique(dim, "k")
    with pytest.raises(DuplicateKeyError, match="1 surplus"):
        require_unique(dim.union(dim.limit(1)), "k")


def test_orphans(facts, dim):
    assert rows(orphans(facts, dim, "k")) == [(9, 40)]
    assert rows(orphan_counts(facts, dim, "k", "d")) == [("d", 1, 1)]


def test_orphans_is_an_anti_join(facts, dim):
    assert "LeftAnti" in plan(orphans(facts, dim, "k"))


def test_fact_has_31_columns_in_order(spark, sf_dir):
    parts = (f(spark, sf_dir) for f in (stand_ins.raw_orders, stand_ins.products, stand_ins.customers))
    columns = orders.fact(*parts).columns
    assert len(columns) == 31
    assert columns[:3] == ["customer_id", "product_id", "order_id"]
    assert columns[-3:] == ["unit_profit", "total_profit", "profit_margin_pct"]


def test_hot_key_of_a_large_dimension_is_split(spark, conf, tmp_path):
    """A third of the rows share one key and the dimension is too large to broadcast."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__shuffle__partitions="20",
    )
    n = 120_000
    facts = spark.range(n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    dim = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("name"))
    joined = lookup(facts, dim, "k", ["name"])
    out = joined.groupBy((F.col("name") % 10).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.max("payload").alias("p")
    )
    assert "skew=true" in final_plan(out)
    assert out.agg(F.sum("n")).first()[0] == n


def test_hot_key_is_split_before_an_aggregate_on_it(spark, conf):
    """As in a reload, where the rows of some keys are picked and then deduplicated."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__shuffle__partitions="20",
    )
    raw = spark.range(120_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50_000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    keys = spark.range(0, 50_000, 7).select(F.col("id").alias("k"))
    kept = keep_one(raw.join(keys, "k", "left_semi"), ["k"])
    assert "skew=true" in final_plan(kept)
    expected = raw.filter("k % 7 = 0").groupBy("k").agg(F.min("payload").alias("payload"))
    assert rows(kept) == rows(expected)


def test_rows_without_a_key_are_no_duplicates(spark, dim):
    nameless = spark.createDataFrame([(None, "x", 0), (None, "y", 0)], "k int, name string, x int")
    assert require_unique(dim.union(nameless), "k") == 5


def test_the_fact_is_spread_once_after_the_joins(spark, sf_dir, conf, tmp_path):
    parts = [f(spark, sf_dir) for f in (stand_ins.raw_orders, stand_ins.products, stand_ins.customers)]
    orders.write_fact(*parts, str(tmp_path / "broadcast"))
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    orders.write_fact(*parts, str(tmp_path / "shuffled"))
    one, two = (spark.read.parquet(str(tmp_path / p)) for p in ("broadcast", "shuffled"))
    assert one.columns == two.columns
    assert rows(one) == rows(two)


def test_hot_keys_are_those_with_a_share(spark):
    df = spark.range(1000).selectExpr("case when id % 2 = 0 then 7 when id % 5 = 0 then null else id end as k")
    assert hot_keys(df, "k", share=0.1) == [7]
    assert hot_keys(df.limit(0), "k") == []


def test_hot_and_null_keys_without_help_at_run_time(spark, conf):
    """AQE's skew join is off, a third of the rows share a key and a third have none."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="32",
    )
    n = 30_000
    df = spark.range(n, numPartitions=16).selectExpr("case id % 3 when 0 then 5 when 1 then null else id end as k", "id as v")
    dim = spark.range(n).selectExpr("id as k", "concat('n', id) as name", "1 as other")
    hot = hot_keys(df, "k", share=1 / 64)
    assert hot == [5]
    salted, plain = lookup_hot(df, dim, "k", ["name"], hot, salts=32), lookup(df, dim, "k", ["name"])
    assert rows(salted.select("k", "v", "name")) == rows(plain.select("k", "v", "name"))
    most = lambda d: d.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most(plain) > n / 3
    assert most(salted) < n / 8
    assert plan(salted).startswith("Union")  # rows without a key go round the join
    assert rows(lookup_hot(df, dim, "k", ["name"], []).select("k", "v", "name")) == rows(plain.select("k", "v", "name"))


def test_hot_keys_read_the_rows_once(spark, tmp_path, conf):
    """Counting them all and picking the hot ones were two jobs, each with every shuffle behind the rows."""
    spark.range(1000).selectExpr("id % 9 as k").write.parquet(str(tmp_path / "rows"))
    store = spark._jsparkSession.sharedState().statusStore()
    listeners = spark.sparkContext._jsc.sc().listenerBus()
    listeners.waitUntilEmpty(30_000)
    df, before = spark.read.parquet(str(tmp_path / "rows")), store.executionsCount()
    assert len(hot_keys(df, "k", share=0.05)) == 9
    listeners.waitUntilEmpty(30_000)
    assert store.executionsCount() == before + 1
    last = store.executionsList().last()
    assert last.physicalPlanDescription().split("== Initial Plan ==")[0].count("ReusedExchange") >= 1
