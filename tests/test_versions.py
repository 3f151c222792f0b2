"""Versions: what readers see while tables are written, checked and switched."""

import os

import pytest
from conftest import rows

from millrace.sources import storage, versions
from millrace.sources.versions import Draft, NothingPublished
from millrace.sources.writers import fingerprint, verify_tables, write_partitioned, write_table, write_watched

KIND = "v int, p string"


def write(spark, root, data, draft=None):
    draft = draft or Draft(spark, root)
    write_partitioned(spark.createDataFrame(data, KIND), draft.path("t"), ["p"])
    return draft


def test_nothing_is_visible_before_publish(spark, tmp_path):
    root = str(tmp_path / "star")
    assert versions.live(spark, root) is None
    draft = write(spark, root, [(1, "a")])
    with pytest.raises(NothingPublished):
        versions.read(spark, root, "t")
    draft.publish({"t": [draft.folder("t")]}, note=7)
    assert rows(versions.read(spark, root, "t")) == [(1, "a")]
    write(spark, root, [(2, "b")])
    assert rows(versions.read(spark, root, "t")) == [(1, "a")]
    assert versions.live(spark, root).facts == {"note": 7}
    with pytest.raises(NothingPublished):
        versions.read(spark, root, "other")


def test_of_two_writers_the_second_fails_and_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "star")
    first, second = write(spark, root, [(1, "a")]), write(spark, root, [(2, "a")])
    first.publish({"t": [first.folder("t")]})
    with pytest.raises(FileExistsError):
        second.publish({"t": [second.folder("t")]})
    assert rows(versions.read(spark, root, "t")) == [(1, "a")]
    assert storage.names(spark, f"{root}/_versions") == ["000000000001.json"]


def test_a_table_of_partitions_from_several_versions(spark, tmp_path):
    root = str(tmp_path / "star")
    one = write(spark, root, [(1, "a"), (2, "b/%"), (3, None)])
    one.publish({"t": [one.folder("t")]})
    leaves = versions.partitions(spark, root, one.folder("t"), 1)
    assert len(leaves) == 3
    two = write(spark, root, [(9, "a")])
    two.publish({"t": [*(leaf for leaf in leaves if not leaf.endswith("p=a")), two.folder("t")]})
    schema = spark.createDataFrame([], KIND).schema
    for read in (versions.read(spark, root, "t"), versions.read(spark, root, "t", schema)):
        assert rows(read.select("v", "p")) == [(2, "b/%"), (3, None), (9, "a")]


def test_tidy_drops_what_no_kept_manifest_names(spark, tmp_path):
    root = str(tmp_path / "star")
    one = write(spark, root, [(1, "a"), (2, "b")])
    one.publish({"t": [one.folder("t")]})
    dead = write(spark, root, [(7, "z")])
    two = write(spark, root, [(3, "a")])
    two.publish({"t": [f"{one.folder('t')}/p=b", two.folder("t")]})
    assert sorted(versions.tidy(spark, root)) == [dead.folder("t")]
    assert sorted(versions.tidy(spark, root, keep=1)) == [f"{one.folder('t')}/p=a"]
    assert rows(versions.read(spark, root, "t")) == [(2, "b"), (3, "a")]
    assert versions.tidy(spark, root, keep=1) == []


def test_a_manifest_is_whole_or_not_there(spark, tmp_path):
    path = str(tmp_path / "x" / "m.json")
    storage.write_new(spark, path, "{}")
    with pytest.raises(FileExistsError):
        storage.write_new(spark, path, "other")
    assert storage.read_text(spark, path) == "{}"
    assert [n for n in os.listdir(tmp_path / "x") if not n.endswith(".crc")] == ["m.json"]


def test_fingerprint_goes_by_rows_not_by_order(spark):
    data = [(1, "a"), (2, None), (None, "a"), (None, None), (1, "a")]
    of = lambda d: tuple(spark.createDataFrame(d, KIND).repartition(3).agg(*fingerprint(spark.createDataFrame(d, KIND))).first())
    assert of(data) == of(data[::-1]) and of(data)[0] == 5
    assert len({of(data), of(data[:4]), of([*data[:4], (1, "b")]), of([(1, None), (2, "a"), *data[2:]])}) == 4
    assert of([]) == (0, "0")
    moved = spark.createDataFrame([("a", 1)], "p string, v int")
    assert tuple(moved.agg(*fingerprint(moved)).first()) == of([(1, "a")])


def test_an_altered_file_is_found(spark, tmp_path):
    path = str(tmp_path / "t")
    seen = write_watched(spark.range(1000).selectExpr("id", "id % 7 as x"), path)
    assert seen["rows"] == 1000
    check = lambda: verify_tables({"t": spark.read.parquet(path)}, {"t": seen}).first()["intact"]
    assert check() is True
    name = next(n for n in os.listdir(path) if n.startswith("part-") and n.endswith(".parquet"))
    held = spark.read.parquet(f"{path}/{name}")
    write_table(held.selectExpr("id", "x + if(id = (select min(id) from {t}), 1, 0) as x".replace("{t}", f"parquet.`{path}/{name}`")), str(tmp_path / "u"))
    other = next(n for n in os.listdir(tmp_path / "u") if n.endswith(".parquet") and not n.startswith("."))
    os.replace(tmp_path / "u" / other, f"{path}/{name}")
    crc = f"{path}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert verify_tables({"t": spark.read.parquet(path)}).first()["rows"] == 1000
    assert check() is False
    assert verify_tables({"t": spark.read.parquet(path)}, {}).first()["intact"] is None
