"""Parquet and JSON sinks, and the checks on what they wrote."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


def write_watched(df: DataFrame, path: str) -> dict[str, object]:
    """Replace an unpartitioned table; returns ``rows`` and ``checksum`` of what went out."""
    out, seen = watched(df)
    write_table(out, path)
    return seen.get


def write_tables(tables: Mapping[str, DataFrame]) -> dict[str, dict[str, object]]:
    """Replace several tables, by path, at once: each alone would leave a cluster idle."""
    return at_once({path: lambda df=df, path=path: write_watched(df, path) for path, df in tables.items()})


def at_once(jobs: Mapping[str, Callable[[], object]]) -> dict:
    """Results of independent jobs, by name, run side by side."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: done.result() for name, done in running.items()}


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Bring rows of one output partition together, in tasks of even size.

    Unlike ``repartition(*by)`` this splits a partition that holds much of the
    table over many tasks, and merges small ones.
    """
    return df.hint("rebalance", *by)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    only_touched: bool = False,
    already_spread: bool = False,
) -> dict[str, object]:
    """Replace a partitioned table with few files per partition.

    ``only_touched`` replaces only the partitions present in ``df``. Rows are
    spread on the partition columns first, unless the plan has done so before
    and has not shuffled since. Returns ``rows`` and ``checksum`` of what went out.
    """
    mode = "dynamic" if only_touched else "static"
    out, seen = watched(df if already_spread else spread(df, *by))
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).parquet(path)
    return seen.get


def fingerprint(df: DataFrame) -> list[Column]:
    """``rows`` and ``checksum`` aggregates; the same rows give the same values in any order.

    The sum of a 64-bit hash per row, which also covers where a row's nulls are. Columns go by
    name, so partition columns may come back last.
    """
    names = sorted(df.columns)
    nulls = [
        reduce(lambda a, b: a + b, (F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(part)))
        for part in (names[k : k + 30] for k in range(0, len(names), 30))
    ]
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c in names), *nulls)
    total = F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0)).cast("string")
    return [F.count(F.lit(1)).alias("rows"), total.alias("checksum")]


def watched(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, counted and summed up as the next action takes them.

    The last stage of an action adds a task's share once, however often the task runs, so
    watch what goes straight to the files, after all shuffles.
    """
    seen = Observation()
    return df.observe(seen, *fingerprint(df)), seen


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def verify_tables(
    written: Mapping[str, DataFrame], expected: Mapping[str, Mapping[str, object]] | None = None
) -> DataFrame:
    """(table, rows, columns) of each written table, as read back.

    With ``expected``, what `watched` saw on the way out by table, also ``intact``: whether the
    table read back has the same rows; null for a table that was not watched. Without it,
    no column is read, and rows are counted from the footers of the files.
    """
    counted = []
    for name, df in written.items():
        constants = [F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")]
        if expected is None:
            counted.append(df.agg(F.count(F.lit(1)).alias("rows")).select(*constants))
            continue
        seen = expected.get(name)
        same = F.lit(None).cast("boolean")
        if seen is not None:
            same = (F.col("rows") == seen["rows"]) & (F.col("checksum") == seen["checksum"])
        counted.append(df.agg(*fingerprint(df)).select(*constants, same.alias("intact")))
    return reduce(DataFrame.unionByName, counted)


def verify_partitions(written: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of partitions read back, and of those with a null partition value."""
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in by])
    return (
        written.select(*by)
        .distinct()
        .agg(
            F.count(F.lit(1)).alias("partitions"),
            F.count_if(has_null).alias("null_partitions"),
        )
    )
