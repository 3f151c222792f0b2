"""Reload in place: fold a batch of raw rows into a bare fact table, with the raw history at hand.

For a table that is loaded with survivors kept, `millrace.plans.survivors` needs no history.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import storage
from millrace.sources.readers import read_parquet
from millrace.sources.writers import write_partitioned, write_table


def reload_partitions(
    spark: SparkSession,
    path: str,
    history: DataFrame,
    batch: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    key: str,
    by: Sequence[str],
) -> int:
    """Bring the fact at ``path`` to what a full load of history and batch gives.

    A new row can displace the row kept for its key, which may sit in another
    partition. So all raw rows of the batch's keys are built again, and every
    partition that held or will hold one of those keys is rewritten; the others
    are neither read in full nor touched. Finding the raw rows reads ``history``
    once: give it split by a range of the key where that is too much, and pass
    only the parts the batch can touch. Returns the number of partitions rewritten.

    Rewritten partitions are staged beside the table, on the same file system, and
    the staging is removed at the end. Replacing partitions and deleting those left
    without rows are two steps; if the job fails between them, run it again with the
    same batch: the stale rows have keys of the batch, so their partitions are found
    and deleted then.
    """
    staging = f"{storage.parent(spark, path)}/_staging-{uuid.uuid4().hex}"
    try:
        return _reload(spark, path, staging, history, batch, build, key, list(by))
    finally:
        storage.delete_folder(spark, staging)


def _reload(spark, path, staging, history, batch, build, key, by) -> int:
    keys = batch.select(key).distinct()
    raw = history.unionByName(batch)
    # Null keys match nothing here, and no loaded row has one.
    write_table(build(raw.join(keys, key, "left_semi")), f"{staging}/rows")
    rebuilt = read_parquet(spark, f"{staging}/rows")
    loaded = read_parquet(spark, path, schema=rebuilt.schema)
    rebuilt = rebuilt.select(*loaded.columns)

    touched = loaded.join(keys, key, "left_semi").select(*by).union(rebuilt.select(*by))
    write_table(touched.distinct(), f"{staging}/touched")  # one row per partition at most
    touched = read_parquet(spark, f"{staging}/touched", schema=loaded.select(*by).schema)
    count = touched.count()
    if not count:
        return 0

    # Staged first: the partitions replaced below are themselves read for this.
    kept = _in_partitions(loaded, touched, by).join(keys, key, "left_anti")
    write_table(kept.unionByName(rebuilt), f"{staging}/partitions")
    merged = read_parquet(spark, f"{staging}/partitions", schema=loaded.schema)
    # A partition left without rows is not part of the write. Its folder is named as the
    # files in it are, whatever characters the values hold.
    filled = merged.select(*by).distinct()
    emptied = touched.join(filled, _same(touched, filled, by), "left_anti")
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    at = loaded.select(*by, folder)
    stale = [r["folder"] for r in _in_partitions(at, emptied, by).select("folder").distinct().collect()]
    write_partitioned(merged, path, by, only_touched=True)
    for found in stale:
        storage.delete_uri(spark, found)
    return count


def _same(left: DataFrame, right: DataFrame, by: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in by])


def _in_partitions(rows: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the wanted partitions; plain equality lets the scan leave out the others."""
    no_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    plain = rows.join(wanted.filter(no_null), list(by), "left_semi")
    some_null = rows.filter(~no_null)
    nulls = wanted.filter(~no_null)
    return plain.unionByName(some_null.join(nulls, _same(some_null, nulls, by), "left_semi"))
