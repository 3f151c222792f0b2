import json

import pytest
from conftest import rows

from millrace import session
from millrace.sources.readers import read_csv, read_json, read_parquet, source_summary
from millrace.sources.schemas import PRODUCTS, RAW_ORDERS

HEADER = "order_id,order_date,customer_id,product_id,quantity,unit_price,discount_pct,payment_method,status"
GOOD = "1,2023-01-01 00:00:00,5.0,7,2,10.5,10,Cash,Completed"
BAD_CELL = "2,2023-01-01 00:01:00,5.0,7,two,10.5,10,Cash,Completed"
EMPTY_CELLS = "3,2023-01-01 00:02:00,,7,2,,10,Cash,Completed"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_with_schema_nulls_bad_and_empty_cells(spark, tmp_path):
    path = write(tmp_path / "o.csv", HEADER, GOOD, BAD_CELL, EMPTY_CELLS)
    df = read_csv(spark, path, schema=RAW_ORDERS)
    assert df.schema == RAW_ORDERS
    found = {r["order_id"]: r for r in df.collect()}
    assert found[2]["quantity"] is None and found[2]["unit_price"] == 10.5
    assert found[3]["customer_id"] is None and found[3]["unit_price"] is None


def test_csv_keeps_the_text_of_bad_lines(spark, tmp_path):
    path = write(tmp_path / "o.csv", HEADER, GOOD, BAD_CELL)
    df = read_csv(spark, path, schema=RAW_ORDERS, keep_corrupt=True)
    assert {r["order_id"]: r["_corrupt_record"] for r in df.collect()} == {1: None, 2: BAD_CELL}


@pytest.mark.parametrize("keep_corrupt", [False, True])
def test_csv_with_reordered_header_is_refused(spark, tmp_path, keep_corrupt):
    names = HEADER.split(",")
    swapped = ",".join([names[1], names[0], *names[2:]])
    path = write(tmp_path / "o.csv", swapped, GOOD)
    with pytest.raises(Exception, match="header"):
        read_csv(spark, path, schema=RAW_ORDERS, keep_corrupt=keep_corrupt).collect()


def test_csv_inferred(spark, tmp_path):
    path = write(tmp_path / "c.csv", "customer_id,city,since", "1,Austin,2020-01-01 10:00:00", "2,,")
    df = read_csv(spark, path)
    assert df.dtypes[:2] == [("customer_id", "int"), ("city", "string")]
    assert df.dtypes[2][1].startswith("timestamp")


PRODUCT = dict(
    product_id=1, product_name="p", category="Toys", brand="b", cost_price=1.5, is_active=True,
    weight_kg=0.5,
)


def test_json_forms(spark, tmp_path):
    two = [PRODUCT, {**PRODUCT, "product_id": 2}]
    array = write(tmp_path / "array.json", json.dumps(two))
    lines = write(tmp_path / "lines.json", *(json.dumps(p) for p in two))
    pretty = write(tmp_path / "pretty.json", json.dumps(two, indent=2))
    expected = rows(read_json(spark, lines, schema=PRODUCTS))
    assert len(expected) == 2
    assert rows(read_json(spark, array, schema=PRODUCTS)) == expected
    assert rows(read_json(spark, pretty, schema=PRODUCTS, multi_line=True)) == expected
    inferred = read_json(spark, array)
    assert dict(inferred.dtypes)["product_id"] == "bigint"
    assert rows(inferred.select(*PRODUCTS.fieldNames())) == expected


def test_parquet_files_as_one_table(spark, tmp_path):
    paths = [str(tmp_path / f"m{i}") for i in range(3)]
    for i, path in enumerate(paths):
        spark.range(i, i + 2).write.parquet(path)
    assert rows(read_parquet(spark, *paths)) == [(0,), (1,), (1,), (2,), (2,), (3,)]
    spark.sql("select 9L as id, 'x' as extra").write.parquet(str(tmp_path / "wider"))
    both = read_parquet(spark, paths[0], str(tmp_path / "wider"), merge_schema=True)
    assert rows(both) == [(0, None), (1, None), (9, "x")]


def test_source_summary(spark, tmp_path):
    spark.range(6).repartition(2).write.parquet(str(tmp_path / "a"))
    sources = {"a": spark.read.parquet(str(tmp_path / "a")), "b": spark.range(3)}
    assert rows(source_summary(sources)) == [("a", 6, 1, 2), ("b", 3, 1, 0), ("total", 9, 2, 2)]


def test_shuffles_are_cut_by_the_size_of_the_input(spark, conf):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    conf(**{key.replace(".", "__"): "8"})
    session.configure(spark, input_bytes=10 * 2**40)
    assert spark.conf.get(key) == str(10 * 2**40 // (128 * 2**20))


def test_scratch_root_is_the_shared_folder(spark, monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Cluster:
        conf = Conf("hdfs://shared/scratch/")

        class sparkContext:
            master = "spark://host:7077"

    assert session.scratch_root(Cluster) == "hdfs://shared/scratch"
    Cluster.conf = Conf(None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster)
    assert session.fresh_dir(spark, "x") != session.fresh_dir(spark, "x")


def test_shuffle_partitions_grow_with_the_data():
    assert session.shuffle_partitions(1) == 8
    assert session.shuffle_partitions(100 * 2**40) == 100 * 2**40 // (128 * 2**20)


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    from millrace.session import fresh_dir, scratch_scope
    from millrace.sources import storage

    outer = fresh_dir(spark, "outer")
    spark.range(3).write.parquet(outer)
    with scratch_scope(spark):
        one = fresh_dir(spark, "one")
        spark.range(5).write.parquet(one)
        with scratch_scope(spark):
            two = fresh_dir(spark, "two")
            spark.range(7).write.parquet(two)
        assert storage.names(spark, two) == [] and spark.read.parquet(one).count() == 5
    assert storage.names(spark, one) == [] and spark.read.parquet(outer).count() == 3
