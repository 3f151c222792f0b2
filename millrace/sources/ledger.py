"""Which input files were taken in, so that a rerun finds the new ones by itself.

The ledger is a table (path, length, modified, loaded_in), a row per file, and is published in
the same step as the tables that the files went into: a file is either in both or in neither.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, length long, modified timestamp, loaded_in long"


class FileChanged(ValueError):
    """A file that was taken in before has another size or time now."""


def files_below(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length, modified) of the files in a folder and below; their contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def not_taken_in(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger lacks. Raises if one that it has is not the same any more."""
    before = ledger.select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"))
    known = found.join(before, "path")
    other = known.filter("length <> old_length or modified <> old_modified")
    changed = other.agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("path")).first()
    if changed["files"]:
        raise FileChanged(f"{changed['files']} files changed after they were taken in, {changed['path']} among them")
    return found.join(before.select("path"), "path", "left_anti")


def readable_path(path: str) -> str:
    """A path as a reader takes it literally, whatever characters it holds."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
