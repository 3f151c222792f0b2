"""The marked pass: what stays, what goes and why, decided once."""

import re

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_clean import make_orders
from test_sinks import dims

from millrace.operators import judge
from millrace.operators.clean import keep_one
from millrace.operators.rules import Rule
from millrace.plans import orders
from verification import stand_ins

KIND = "k int, a int, b string"
RULES = [Rule("no_key", "k is not null"), Rule("again", "not is_surplus"), Rule("small", "a > 0")]


def expected(data):
    """Rows with copies, surplus and reason, by plain Python."""
    nulls_first = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:])
    out = []
    for key in {r[0] for r in data}:
        held = sorted((r for r in data if r[0] == key), key=nulls_first)
        for i, r in enumerate(held):
            reason = "no_key" if key is None else "again" if i else None if (r[1] or 0) > 0 else "small"
            out.append((*r, None if i else len(held), bool(i), reason))
    return sorted(out, key=repr)


def found(judged):
    return rows(judged.select("k", "a", "b", "__copies", "is_surplus", "reason"))


rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.integers(0, 2)), st.sampled_from(["x", "y"])),
    max_size=25,
)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 26])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows_strategy, parts=st.integers(1, 5))
def test_judged_rows_equal_brute_force(spark, tmp_path_factory, bits, data, parts):
    path = str(tmp_path_factory.mktemp("j") / "judged")
    df = spark.createDataFrame(data, KIND).repartition(parts)
    before, judge.FILTER_BITS = judge.FILTER_BITS, bits
    try:
        judged = judge.write_judged(df, RULES, path, keys=["k"])
        assert found(judged) == expected(data)
        assert rows(judge.all_rows(judged)) == rows(df)
        assert rows(judge.one_each(judged).drop("__copies")) == rows(keep_one(df, ["k"]))
    finally:
        judge.FILTER_BITS = before


def test_keys_that_share_a_bit_only_take_the_long_way(spark, tmp_path, monkeypatch):
    """With one bit in the map every row is put aside, and the outcome is the same."""
    monkeypatch.setattr(judge, "FILTER_BITS", 1)
    data = [(i % 40, i, "x") for i in range(60)]
    df = spark.createDataFrame(data, KIND).repartition(3)
    judged = judge.write_judged(df, RULES, str(tmp_path / "judged"), keys=["k"])
    assert found(judged) == expected(data)
    assert spark.read.parquet(str(tmp_path / "judged")).filter("__state = 'aside'").count() == 60


def test_unique_rows_are_not_put_aside(spark, tmp_path):
    n = 20_000
    df = spark.range(n, numPartitions=8).selectExpr("if(id % 1000 = 7, 7, id) as k", "1 as a", "'x' as b")
    judge.write_judged(df, RULES, str(tmp_path / "judged"), keys=["k"])
    aside = spark.read.parquet(str(tmp_path / "judged")).filter("__state = 'aside'")
    assert 20 <= aside.count() < 60  # the key that repeats, and next to none that share its bit


def test_the_pass_over_raw_rows_has_no_shuffle(spark):
    df = spark.range(1000).selectExpr("id as k", "1 as a", "'x' as b", "2 as c")
    marks = judge.repeated_keys(df, ["k"])
    exchanged = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(marks))
    assert exchanged and all("k#" in e or "chunk" in e or "_groupingexpression" in e for e in exchanged)
    assert not any(c in plan(marks) for c in (" a#", " b#", " c#"))
    text = plan(judge.may_repeat(df, ["k"], marks, "aside"))
    over_raw = text[: text.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in over_raw and "BroadcastHashJoin" in over_raw


def test_a_key_with_a_third_of_the_rows_sends_one_row_per_task(spark, tmp_path):
    n = 9000
    df = spark.range(n, numPartitions=12).selectExpr("if(id % 3 = 0, -1, id) as k", "cast(id % 5 as int) as a", "'x' as b")
    judged = judge.write_judged(df, RULES, str(tmp_path / "judged"), keys=["k"])
    assert judged.filter("not is_surplus").count() == df.select("k").distinct().count()
    assert judged.filter("k = -1 and not is_surplus").first()["__copies"] == n // 3
    # What finds the least row is merged before it is shuffled, and the marks go by unique numbers.
    aside = spark.read.parquet(str(tmp_path / "judged")).filter("__state = 'aside'")
    text = plan(aside.groupBy("k").agg(F.min(F.struct("a", "b", "__row"))))
    assert text.index("partial_min") > text.index("Exchange")


def test_orders_are_judged_as_cleaned(spark, sf_dir):
    raw = stand_ins.raw_orders(spark, sf_dir)
    judged = orders.judge(raw)
    assert rows(orders.cleaned_of(judged)) == rows(orders.clean(raw))
    assert {r["reason"] for r in orders.rejected_of(judged).select("reason").distinct().collect()} == {r.name for r in orders.RULES} - {"order_id_missing"}


def exchanges(spark, since):
    """Columns that each shuffle of the SQL executions after ``since`` carries."""
    store = spark._jsparkSession.sharedState().statusStore()
    found = store.executionsList()
    out = []
    for i in range(found.size()):
        run = found.apply(i)
        if run.executionId() <= since:
            continue
        text = run.physicalPlanDescription()
        tree, _, details = text.partition("\n\n\n")
        final = tree.split("== Initial Plan ==")[0]
        numbers = re.findall(r"\bExchange \((\d+)\)", final)
        for number in numbers:
            found_columns = re.search(rf"^\({number}\) Exchange\nInput \[\d+\]: (.*)\n", details, re.M)
            out.append(found_columns[1])
    return out


def last_execution(spark):
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max((found.apply(i).executionId() for i in range(found.size())), default=-1)


def test_a_load_with_quarantine_shuffles_its_rows_once(spark, tmp_path):
    raw = make_orders(spark, *(dict(order_id=i) for i in range(50)), dict(order_id=3), dict(order_id=60, quantity=0))
    for name, df in zip(("raw", "products", "customers"), (raw, *dims(spark))):
        df.write.parquet(str(tmp_path / name))
    tables = [spark.read.parquet(str(tmp_path / name)) for name in ("raw", "products", "customers")]
    since = last_execution(spark)
    log = orders.run(spark, *tables, str(tmp_path / "star"), quarantine=True).first()
    assert log["transform"]["rows_removed"] == 2
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    # Of the shuffles that carry whole rows, only the fact's on its way to its partitions is left.
    [fact] = [columns for columns in exchanges(spark, since) if "payment_method#" in columns]
    assert fact.count("#") == 31


def test_kept_rows_and_one_of_each_join_nothing(spark, tmp_path):
    """Marking surplus rows took a shuffle of all rows put aside, also where nobody asked for them."""
    path = str(tmp_path / "judged")
    data = [(i % 40, i % 3, "x") for i in range(60)]
    df = spark.createDataFrame(data, KIND).repartition(3)
    judged = judge.write_judged(df, RULES, path, keys=["k"])
    for asked in (judge.kept_rows(judged), judge.one_each(judged), judge.rows_as_read(df, path)):
        assert "Join" not in plan(asked) and "Exchange" not in plan(asked)
    assert rows(judge.rows_as_read(df, path)) == rows(df)
    assert judge.rejected_rows(judged).filter("reason = 'again'").count() == 20


def test_a_surplus_row_that_no_rule_turns_down_is_kept(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "x"), (2, 0, "x"), (1, 0, "y")], KIND)
    judged = judge.write_judged(df, [RULES[0], RULES[2]], str(tmp_path / "judged"), keys=["k"])
    assert rows(judge.kept_rows(judged)) == [(1, 1, "x"), (1, 2, "x")]
    assert judge.rejected_rows(judged).count() == 2
