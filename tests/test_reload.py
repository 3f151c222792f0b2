"""Reloads from survivors: results, what is read, and runs that die."""

import os
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_clean import make_orders
from test_sinks import dims

from millrace.operators.summaries import distinct_values, merged, partial_states, summarise
from millrace.plans import orders, survivors
from millrace.plans.runlog import read_log
from millrace.sources import versions, writers


def day(d, month=1):
    return datetime(2023, month, d, 10)


def full(spark, raw, root):
    orders.run(spark, raw, *dims(spark), root, publish_failed=True)
    return orders.tables(spark, root)


def same_tables(a, b):
    for name in orders.TABLES:
        columns = sorted(a[name].columns)
        assert sorted(b[name].columns) == columns
        assert rows(a[name].select(columns)) == rows(b[name].select(columns)), name


HISTORY = [
    dict(order_id=1, order_date=day(5, 5)),
    dict(order_id=1, order_date=day(6, 5)),
    dict(order_id=2, order_date=day(3, 3)),
    dict(order_id=3, quantity=0, order_date=day(1, 2)),  # rejected, but holds its key
    dict(order_id=4, customer_id=8.0, order_date=day(3, 3)),
    dict(order_id=None),
    dict(order_id=7, order_date=day(9, 9), status="Returned"),
]
BATCHES = {
    "displaces and moves": [dict(order_id=1, order_date=day(4, 4)), dict(order_id=9, order_date=day(4, 4))],
    "an invalid row takes its valid twin's place": [dict(order_id=2, order_date=day(1, 1), quantity=0)],
    "a valid row takes an invalid one's place": [dict(order_id=3, order_date=day(1, 1))],
    "loses": [dict(order_id=2, order_date=day(30, 3)), dict(order_id=1, order_date=day(30, 12))],
    "copies": [dict(order_id=2, order_date=day(3, 3))] * 3,
    "keys that are missing": [dict(order_id=None), dict(order_id=None, quantity=5)],
    "a last row of a partition goes": [dict(order_id=7, order_date=day(1, 8))],
    "one key many times": [dict(order_id=2, order_date=day(1 + i % 28, 1)) for i in range(40)],
}


def test_reloads_one_after_the_other_equal_full_loads(spark, tmp_path):
    root, raw = str(tmp_path / "star"), make_orders(spark, *HISTORY)
    orders.run(spark, raw, *dims(spark), root, reloadable=True, publish_failed=True)
    for name, batch in BATCHES.items():
        new = make_orders(spark, *batch)
        raw = raw.union(new)
        orders.reload(spark, new, *dims(spark), root, publish_failed=True)
        expected = orders.fact(raw, *dims(spark))
        columns = sorted(expected.columns)
        found = orders.tables(spark, root)
        assert rows(found["fact_orders"].select(columns)) == rows(expected.select(columns)), name
    same_tables(found, full(spark, raw, str(tmp_path / "full")))
    # Once more, and nothing changes.
    before = versions.live(spark, root).tables["fact_orders"]
    log = orders.reload(spark, new, *dims(spark), root, publish_failed=True).first()
    assert log["load"]["rows"] == {"changed_keys": 0, "partitions_rewritten": 0}
    assert versions.live(spark, root).tables["fact_orders"] == before
    versions.tidy(spark, root, keep=1)
    same_tables(orders.tables(spark, root), orders.tables(spark, str(tmp_path / "full")))


def test_reload_of_an_empty_load_and_of_nothing(spark, tmp_path):
    root, raw = str(tmp_path / "star"), make_orders(spark, *HISTORY)
    orders.run(spark, raw.limit(0), *dims(spark), root, reloadable=True)
    orders.reload(spark, raw.limit(0), *dims(spark), root)
    orders.reload(spark, raw, *dims(spark), root, publish_failed=True)
    same_tables(orders.tables(spark, root), full(spark, raw, str(tmp_path / "full")))


def test_without_survivors_there_is_no_reload(spark, tmp_path):
    root, raw = str(tmp_path / "star"), make_orders(spark, *HISTORY)
    orders.run(spark, raw, *dims(spark), root, publish_failed=True)
    with pytest.raises(versions.NothingPublished):
        orders.reload(spark, raw, *dims(spark), root)
    last = read_log(spark, f"{root}/run_log").orderBy(F.desc("run_timestamp")).filter("error is not null").first()
    assert last["status"] == "FAILED" and "survivors" in last["error"]


def test_a_small_batch_reads_little(spark, tmp_path, monkeypatch):
    """A hundredth of the rows, the newest: neither raw history nor most of fact and survivors is read."""
    n = 40_000
    start = datetime(2015, 1, 1)
    raw = spark.range(n, numPartitions=8).selectExpr(
        "id as order_id",
        f"timestamp_ntz'{start}' + make_interval(0, 0, 0, cast(id * 3650 / {n} as int)) as order_date",
        "5.0D as customer_id", "7L as product_id", "2 as quantity", "10.0D as unit_price", "10 as discount_pct",
        "sha2(cast(id as string), 256) as payment_method", "'Completed' as status",
    )
    monkeypatch.setattr(survivors, "ROWS_PER_BUCKET", 200)
    path, root = str(tmp_path / "raw"), str(tmp_path / "star")
    raw.filter(f"order_id < {n - n // 100}").write.parquet(path)
    orders.run(spark, spark.read.parquet(path), *dims(spark), root, reloadable=True)
    live = versions.live(spark, root)
    read = {"fact_orders": [], "survivors_fact_orders": []}
    real = versions.read_folders

    def seen(session, at, table, folders, schema=None):
        if table in read and not any(f in folders for f in live.tables[table]):
            read[table] += [f for f in folders if live.tables[table][0].split("/")[1] in f]
        elif table in read:
            read[table] += folders
        return real(session, at, table, folders, schema)

    monkeypatch.setattr(versions, "read_folders", seen)
    assert len(os.listdir(f"{root}/{live.tables['survivors_fact_orders'][0]}")) > 100
    batch = raw.filter(f"order_id >= {n - n // 100}")
    orders.reload(spark, batch, *dims(spark), root)
    monkeypatch.undo()
    def size(folders):
        return sum(os.path.getsize(os.path.join(d, f)) for at in folders for d, _, names in os.walk(f"{root}/{at}") for f in names if f.endswith(".parquet"))

    for table, folders in read.items():
        assert size(set(folders)) < 0.05 * size(live.tables[table]), table
    same_tables(orders.tables(spark, root), full(spark, raw, str(tmp_path / "full")))


def test_survivors_lie_by_ranges_of_the_key(spark, monkeypatch):
    monkeypatch.setattr(survivors, "ROWS_PER_BUCKET", 40)
    rows_ = spark.range(0, 100_000, 10).withColumnRenamed("id", "k")
    assert survivors.range_of_keys(rows_, "k") == (400, 250)
    assert survivors.range_of_keys(rows_.limit(0), "k") == (1, 1)
    text = rows_.select(F.col("k").cast("string").alias("k"))
    assert survivors.range_of_keys(text, "k") == (None, 250)
    found = text.select(survivors.bucket_of("k", None, 250).alias("b")).distinct().count()
    assert 240 < found <= 250
    monkeypatch.setattr(survivors, "BUCKETS", 100)
    assert survivors.range_of_keys(rows_, "k") == (1000, 100)


STEPS = ("write_judged", "write_partitioned", "write_survivors", "write_states", "write_tables", "rule_counts", "verify_tables", "checks", "run_log")


def test_a_run_that_dies_between_any_two_steps_changes_nothing(spark, tmp_path, monkeypatch):
    root, old = str(tmp_path / "star"), make_orders(spark, dict(order_id=1))
    orders.run(spark, old, *dims(spark), root, reloadable=True)
    before = rows(orders.tables(spark, root)["fact_orders"])
    number = versions.live(spark, root).number
    new = make_orders(spark, dict(order_id=1), dict(order_id=2))
    for step in STEPS:
        real = getattr(orders, step)

        def die(*args, real=real, **kwargs):
            real(*args, **kwargs)  # the step is done; the next one never begins
            raise RuntimeError("killed here")

        with monkeypatch.context() as patch:
            patch.setattr(orders, step, die)
            with pytest.raises(RuntimeError):
                orders.run(spark, new, *dims(spark), root, reloadable=True)
        assert versions.live(spark, root).number == number
        assert rows(orders.tables(spark, root)["fact_orders"]) == before
    failed = read_log(spark, f"{root}/run_log").filter("error is not null").collect()
    assert [(r["status"], r["error"]) for r in failed] == [("FAILED", "RuntimeError: killed here")] * len(STEPS)
    orders.run(spark, new, *dims(spark), root, reloadable=True)
    assert len(versions.tidy(spark, root, keep=1)) >= len(STEPS)
    assert orders.tables(spark, root)["fact_orders"].count() == 2


def test_a_reload_that_dies_changes_nothing_and_may_be_run_again(spark, tmp_path, monkeypatch):
    root, raw = str(tmp_path / "star"), make_orders(spark, *HISTORY)
    orders.run(spark, raw, *dims(spark), root, reloadable=True, publish_failed=True)
    before = {name: rows(df) for name, df in orders.tables(spark, root).items()}
    batch = make_orders(spark, *BATCHES["displaces and moves"])

    def die(*args, **kwargs):
        raise RuntimeError("killed here")

    for step in ("write_partitioned", "write_states", "merge_summaries", "write_tables", "write_survivors"):
        with monkeypatch.context() as patch:
            patch.setattr(survivors, step, die)
            with pytest.raises(RuntimeError):
                orders.reload(spark, batch, *dims(spark), root, publish_failed=True)
        assert versions.live(spark, root).number == 1
    assert {name: rows(df) for name, df in orders.tables(spark, root).items()} == before
    orders.reload(spark, batch, *dims(spark), root, publish_failed=True)
    same_tables(orders.tables(spark, root), full(spark, raw.union(batch), str(tmp_path / "full")))


def test_a_run_that_fails_its_checks_leaves_the_tables_before_it(spark, tmp_path):
    root = str(tmp_path / "star")
    orders.run(spark, make_orders(spark, dict(order_id=1)), *dims(spark), root)
    bad = make_orders(spark, dict(order_id=2, product_id=99))
    log = orders.run(spark, bad, *dims(spark), root).first()
    assert (log["status"], log["load"]["published"], log["load"]["version"]) == ("FAILED", False, 2)
    assert [r["order_id"] for r in orders.tables(spark, root)["fact_orders"].collect()] == [1]
    orders.run(spark, bad, *dims(spark), root, publish_failed=True)
    assert [r["order_id"] for r in orders.tables(spark, root)["fact_orders"].collect()] == [2]


def test_merged_states_equal_the_summary(spark, sf_dir):
    from verification import stand_ins

    parts = (f(spark, sf_dir) for f in (stand_ins.raw_orders, stand_ins.products, stand_ins.customers))
    fact = orders.fact(*parts).cache()
    for spec in orders.SUMMARIES.values():
        by = orders.PARTITIONED_BY
        states, values = partial_states(fact, spec, by), distinct_values(fact, spec, by)
        assert rows(merged(states, values, spec)) == rows(summarise(fact, spec))
        near = merged(partial_states(fact, spec.approximate(), by), distinct_values(fact, spec.approximate(), by), spec.approximate())
        assert near.columns == summarise(fact, spec).columns
        assert distinct_values(fact, spec.approximate(), by).count() == 0
    fact.unpersist()


def test_sketches_come_near_the_exact_count(spark):
    from millrace.functions import mergeable
    from millrace.operators.summaries import Summary

    df = spark.range(60_000).selectExpr("id % 3 as g", "id % 7 as piece", "cast(id % 20000 as int) as x")
    spec = Summary(keys={"g": "g"}, measures={"n": mergeable.distinct("x")})
    near = spec.approximate(lg_registers=12)
    states = partial_states(df, near, ["piece"])
    assert states.count() == 21
    for r in merged(states, distinct_values(df, near, ["piece"]), near).collect():
        assert abs(r["n"] - 20_000) < 4 * 1.04 / 64 * 20_000
    assert {r["n"] for r in merged(partial_states(df, spec, ["piece"]), distinct_values(df, spec, ["piece"]), spec).collect()} == {20_000}


def test_the_fact_keeps_its_checksum(spark, tmp_path):
    root = str(tmp_path / "star")
    orders.run(spark, make_orders(spark, *HISTORY), *dims(spark), root, publish_failed=True, quarantine=True)
    seen = versions.live(spark, root).facts["written"]
    assert all(r["intact"] for r in writers.verify_tables(orders.tables(spark, root), seen).collect())
    assert seen["rejected_orders"]["rows"] == 3
    assert versions.read(spark, root, "rejected_orders").count() == 3


def test_timestamps_of_batches_are_kept(spark, tmp_path):
    root = str(tmp_path / "star")
    base = datetime(2023, 1, 1)
    orders.run(spark, make_orders(spark, dict(order_id=1, order_date=base)), *dims(spark), root, reloadable=True)
    orders.reload(spark, make_orders(spark, dict(order_id=2, order_date=base + timedelta(days=1))), *dims(spark), root)
    assert [r["order_date"] for r in orders.tables(spark, root)["fact_orders"].orderBy("order_id").collect()] == [base, base + timedelta(days=1)]


def test_a_reload_leaves_old_survivors_and_merges_many_pieces(spark, tmp_path, monkeypatch):
    """Every reload shuffled and wrote again all survivors of the buckets that its batch touched."""
    monkeypatch.setattr(survivors, "PIECES", 4)
    root, raw = str(tmp_path / "star"), make_orders(spark, *HISTORY)
    orders.run(spark, raw, *dims(spark), root, reloadable=True, publish_failed=True)
    pieces = [versions.live(spark, root).tables["survivors_fact_orders"]]
    for name in ("displaces and moves", "copies", "loses", "one key many times"):
        new = make_orders(spark, *BATCHES[name])
        raw = raw.union(new)
        orders.reload(spark, new, *dims(spark), root, publish_failed=True)
        pieces.append(versions.live(spark, root).tables["survivors_fact_orders"])
    assert pieces[1][:1] == pieces[0] and pieces[2][:2] == pieces[1]
    # The third reload makes one of the first bucket's four pieces; the second bucket has two and keeps them.
    assert [len(p) for p in pieces] == [1, 2, 3, 3, 4]
    assert [p for p in pieces[3] if p in pieces[2]] == [] and pieces[3][-1].endswith("-merged")
    merged_rows = versions.read_folders(spark, root, "survivors_fact_orders", pieces[3])
    assert merged_rows.count() == merged_rows.select("order_id").distinct().count() == 6
    same_tables(orders.tables(spark, root), full(spark, raw, str(tmp_path / "full")))
