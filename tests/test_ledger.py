"""Input files: found by themselves, taken in once."""

import os
import shutil

import pytest
from conftest import rows
from test_enrich import make_trips

from millrace.plans import trips
from millrace.plans.runlog import read_log
from millrace.sources import ledger, versions


def lot(spark, folder, name, *changes):
    make_trips(spark, *changes).coalesce(1).write.parquet(f"{folder}/{name}")


def test_new_files_are_found_and_taken_in_once(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    lot(spark, folder, "a [1]", {}, dict(fare_amount=-1.0))
    first = trips.take_in(spark, folder, root).first()
    assert first["load"]["rows"] == {"files": 1, "raw_rows": 2, "fact_rows": 1}
    again = trips.take_in(spark, folder, root).first()
    assert again["load"]["rows"]["files"] == 0 and not again["load"]["published"]
    assert versions.live(spark, root).number == 1
    lot(spark, folder, "b", {}, {})
    lot(spark, folder, "c", {})
    assert trips.take_in(spark, folder, root).first()["load"]["rows"] == {"files": 2, "raw_rows": 3, "fact_rows": 3}
    tables = trips.tables(spark, root)
    assert tables["fact_trips"].count() == 4
    full = str(tmp_path / "full")
    raw = spark.read.parquet(*(f"{folder}/{n}".replace("[", r"\[").replace("]", r"\]") for n in ("a [1]", "b", "c")))
    trips.run(spark, raw, full)
    for name, df in trips.tables(spark, full).items():
        assert rows(tables[name].select(sorted(df.columns))) == rows(df.select(sorted(df.columns))), name
    assert versions.read(spark, root, trips.LEDGER).groupBy("loaded_in").count().collect()
    assert read_log(spark, f"{root}/run_log").count() == 3


def test_a_changed_file_is_refused(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    lot(spark, folder, "a", {})
    trips.take_in(spark, folder, root)
    lot(spark, folder, "b", {}, {}, {})
    name = lambda d: next(f"{folder}/{d}/{n}" for n in os.listdir(f"{folder}/{d}") if n.endswith(".parquet"))
    for d in ("a", "b"):
        for n in os.listdir(f"{folder}/{d}"):
            if n.endswith(".crc"):
                os.remove(f"{folder}/{d}/{n}")
    shutil.copyfile(name("b"), name("a"))
    with pytest.raises(ledger.FileChanged):
        trips.take_in(spark, folder, root)
    assert trips.tables(spark, root)["fact_trips"].count() == 1


def test_files_of_a_failed_load_are_taken_in_later(spark, tmp_path, monkeypatch):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    lot(spark, folder, "a", {})
    real = trips.write_tables
    monkeypatch.setattr(trips, "write_tables", lambda *_: (_ for _ in ()).throw(RuntimeError("killed here")))
    with pytest.raises(RuntimeError):
        trips.take_in(spark, folder, root)
    monkeypatch.setattr(trips, "write_tables", real)
    assert versions.live(spark, root) is None
    assert trips.take_in(spark, folder, root).first()["load"]["rows"]["files"] == 1


def test_another_year(spark, tmp_path):
    from datetime import datetime

    other = dict(tpep_pickup_datetime=datetime(2023, 2, 3, 4), tpep_dropoff_datetime=datetime(2023, 2, 3, 4, 20))
    raw = make_trips(spark, {}, other)
    root = str(tmp_path / "out")
    log = trips.run(spark, raw, root, year=2023).first()
    assert log["status"] == "SUCCESS" and log["transform"]["quality_issues_found"]["wrong_year"] == 1
    [row] = trips.tables(spark, root)["fact_trips"].collect()
    assert row["tpep_pickup_datetime"] == other["tpep_pickup_datetime"]
    assert [r["reason"] for r in trips.rejected(raw, 2023).collect()] == ["outside_period"]
    assert {r["check"]: r["failures"] for r in trips.checks(trips.fact(raw), 2023).collect()}["wrong_year"] == 1


def test_files_below_reads_no_contents(spark, tmp_path):
    folder = tmp_path / "in" / "deep"
    folder.mkdir(parents=True)
    (folder / "x.parquet").write_text("not parquet at all")
    (folder / "y.csv").write_text("a")
    found = ledger.files_below(spark, str(tmp_path / "in"))
    assert [r["length"] for r in found.collect()] == [18]
    assert "content" not in found.columns
