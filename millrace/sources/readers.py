"""CSV, JSON and Parquet sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.schemas import CORRUPT_RECORD, with_corrupt_record


def read_csv(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with a header line.

    With a schema, cells that do not parse become null and the header must name
    the schema's columns in order: by position alone, a reordered file would be
    read into the wrong columns. Without one, types are inferred, which costs a
    second pass over the files. ``keep_corrupt`` adds the text of lines that had
    an unreadable cell.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(list(paths))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        schema = with_corrupt_record(schema)
    return reader.option("enforceSchema", False).schema(schema).csv(list(paths))


def read_json(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """JSON Lines, or with ``multi_line`` one document (object or array) per file.

    One document per file cannot be split over tasks; keep large tables as lines.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(list(paths))


def read_parquet(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Any number of Parquet files or folders as one table.

    A partitioned table without rows has no file to take the schema from, so it
    can only be read with ``schema``.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema is not None else reader).parquet(*paths)


def _file_path(df: DataFrame) -> Column:
    """Path of the file a row was read from; null for a table that is not read from files."""
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return F.lit(None).cast("string")
    return F.col("_metadata.file_path")


def source_summary(sources: Mapping[str, DataFrame]) -> DataFrame:
    """(source, rows, columns, files) per source, and a ``total`` row.

    Files are counted where rows came from, so a file without rows is not.
    """
    counted = [
        df.select(_file_path(df).alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))
        .select(F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).alias("columns"), "files")
        for name, df in sources.items()
    ]
    # Rolling up repeats no scan: the total comes from the per-source rows.
    return (
        reduce(DataFrame.unionByName, counted)
        .rollup("source")
        .agg(*(F.sum(c).alias(c) for c in ("rows", "columns", "files")))
        .select(F.coalesce("source", F.lit("total")).alias("source"), "rows", "columns", "files")
    )
