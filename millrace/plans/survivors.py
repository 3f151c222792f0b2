"""Folding a batch of new raw rows into a loaded fact, without the raw history.

A full load keeps, beside the fact, its survivors: for each key the raw row that deduplication
kept, whatever later rules made of it. The least of old survivor and batch rows is what a full
load of both would keep, so no other raw row is needed. Survivors lie in buckets, ranges of the
key where it is a whole number and else of its hash, and a reload reads the buckets of its batch
only. It writes the batch's least rows beside them, so a bucket may hold several rows of a key, of which the
least survives; a bucket in PIECES pieces is written anew, a row per key. Old and new rows meet by their keys
alone, and whole old rows are taken up only for keys that both have. Of the fact it reads and rewrites the partitions that lose or gain a row, and makes the summaries'
states of those alone anew, to be merged with the others. Everything new is written beside the old (`versions`), so a
reload that fails changes nothing and is run again.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.clean import COPIES, collapse
from millrace.operators.summaries import Summary, distinct_values, merged, partial_states
from millrace.sources import storage, versions
from millrace.sources.versions import Draft, Manifest
from millrace.sources.writers import at_once, spread, write_partitioned, write_table, write_tables

BUCKET = "bucket"
#: Into how many ranges the keys of the first load are cut: one for so many rows, up to a bound.
ROWS_PER_BUCKET = 10_000
BUCKETS = 4096
#: A bucket of survivors that has come in so many loads is made one again.
PIECES = 8

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Fact:
    """What a reload has to know of a fact table."""

    table: str
    key: str
    order_by: Sequence[str]
    by: Sequence[str]
    #: Survivors -> those that belong in the fact, with the columns ``by``.
    placed: Callable[[DataFrame], DataFrame]
    #: Those -> rows joined to the dimensions, and these -> fact rows, without a shuffle.
    join: Callable[[DataFrame], DataFrame]
    complete: Callable[[DataFrame], DataFrame]
    summaries: Mapping[str, Summary] = field(default_factory=dict)

    @property
    def survivors(self) -> str:
        return f"survivors_{self.table}"

    def states(self, summary: str) -> str:
        return f"state_{summary}"

    def values(self, summary: str) -> str:
        return f"values_{summary}"


def range_of_keys(rows: DataFrame, key: str) -> tuple[int | None, int]:
    """Keys in a bucket, and buckets in all; the former is None where keys go by their hash, for want of whole numbers."""
    whole = isinstance(rows.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    ends = rows.agg(F.count(key).alias("rows"), *(f(F.col(key)).alias(n) for f, n in ((F.min, "low"), (F.max, "high")))).first()
    buckets = min(BUCKETS, max(1, math.ceil(ends["rows"] / ROWS_PER_BUCKET)))
    if not whole:
        return None, buckets
    return 1 if ends["low"] is None else max(1, math.ceil((ends["high"] - ends["low"] + 1) / buckets)), buckets


def bucket_of(key: str, width: int | None, buckets: int) -> Column:
    if width is None:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long")
    return F.expr(f"`{key}` div {width}").cast("long")


def write_survivors(rows: DataFrame, fact: Fact, path: str, width: int | None, buckets: int) -> None:
    """Survivors in files that lie within a bucket and, inside, in the order of the key."""
    placed = rows.filter(F.col(fact.key).isNotNull()).withColumn(BUCKET, bucket_of(fact.key, width, buckets))
    ordered = spread(placed, BUCKET).sortWithinPartitions(BUCKET, fact.key)
    ordered.write.mode("overwrite").option("compression", "zstd").partitionBy(BUCKET).parquet(path)


def state_tables(rows: DataFrame, fact: Fact) -> dict[str, DataFrame]:
    """Partial states and distinct values of all summaries, a piece per fact partition."""
    made = {}
    for name, spec in fact.summaries.items():
        made[fact.states(name)] = partial_states(rows, spec, fact.by)
        made[fact.values(name)] = distinct_values(rows, spec, fact.by)
    return made


def write_states(rows: DataFrame, fact: Fact, draft: Draft) -> dict[str, T.StructType]:
    """Write the states of these fact rows; schemas by table, because a table may stay empty."""
    made = state_tables(rows, fact)
    by = [f"by_{c}" for c in fact.by]
    at_once({name: lambda df=df, name=name: write_partitioned(df, draft.path(name), by) for name, df in made.items()})
    return {name: df.schema for name, df in made.items()}


def merge_summaries(
    spark: SparkSession, root: str, fact: Fact, folders: Mapping[str, Sequence[str]], schemas: Mapping[str, T.StructType]
) -> dict[str, DataFrame]:
    """The summary tables, from the states and values in these folders."""

    def read(name: str) -> DataFrame:
        return versions.read_folders(spark, root, name, folders[name], schemas[name])

    return {name: merged(read(fact.states(name)), read(fact.values(name)), spec) for name, spec in fact.summaries.items()}


def _partition(folder: str, names: Sequence[str]) -> tuple[str | None, ...]:
    """Values of the partition columns in a folder's name, as text."""
    parts = dict(p.split("=", 1) for p in folder.split("/") if "=" in p)
    values = [unquote(parts[n]) for n in names]
    return tuple(None if v == NO_VALUE else v for v in values)


def _replaced(
    spark: SparkSession, root: str, folders: Sequence[str], names: Sequence[str], changed: set
) -> tuple[list[str], list[str]]:
    """Partition folders of a table that are among the changed ones, and the others."""
    leaves = []
    for folder in folders:
        depth = len(names) - sum("=" in p and not p.startswith(f"{versions.COLUMN}=") for p in folder.split("/"))
        leaves += versions.partitions(spark, root, folder, depth)
    inside = [leaf for leaf in leaves if _partition(leaf, names) in changed]
    return inside, [leaf for leaf in leaves if _partition(leaf, names) not in changed]


def _values(rows: DataFrame, names: Sequence[str]) -> set[tuple[str | None, ...]]:
    """Partitions that rows lie in: no more than the table has, so they may come to the driver."""
    return {tuple(r) for r in rows.select(*(F.col(n).cast("string") for n in names)).distinct().collect()}


@dataclass(frozen=True)
class Fold:
    """What a batch changes: folders of every table of the next version, and the rows made anew."""

    tables: dict[str, list[str]]
    rows: DataFrame
    partitions: int
    keys: int


def fold(
    spark: SparkSession, root: str, live: Manifest, batch: DataFrame, fact: Fact, draft: Draft, scratch: Callable[[str], str]
) -> Fold:
    """Write what the next version needs besides what the live one has; publishes nothing.

    The batch has the columns of the raw table, readable rows only. Rows without a key never
    survive. A key whose old row stays costs nothing but its count of copies.
    """
    width, n_buckets = live.facts["survivor_width"]
    raw_columns = batch.columns
    tables = {k: list(v) for k, v in live.tables.items()}
    own = collapse(batch, [fact.key], fact.order_by)
    write_survivors(own, fact, draft.path(fact.survivors), width, n_buckets)
    added = _new(spark, root, draft, fact.survivors)
    newest = versions.read_folders(spark, root, fact.survivors, added, T.StructType([*own.schema, T.StructField(BUCKET, T.LongType())]))
    buckets = _values(newest, [BUCKET])
    if not buckets:
        return Fold(tables, newest.limit(0), 0, 0)
    inside, _ = _replaced(spark, root, live.tables[fact.survivors], [BUCKET], buckets)
    old = versions.read_folders(spark, root, fact.survivors, inside, newest.schema)

    # The least row of a key; one from before wins a tie, as then nothing changes.
    rest = [*fact.order_by, *(c for c in raw_columns if c != fact.key and c not in fact.order_by)]
    met = _kept(newest.select(fact.key).join(old.select(fact.key), fact.key, "left_semi"), scratch("met"))
    both = (
        old.join(met, fact.key, "left_semi").withColumn("is_new", F.lit(False))
        .unionByName(newest.join(met, fact.key, "left_semi").withColumn("is_new", F.lit(True)))
    )
    row = F.struct(*rest)
    least = both.groupBy(fact.key).agg(
        F.min(F.struct(*rest, "is_new")).alias("least"), F.min(F.when(~F.col("is_new"), row)).alias("old")
    )
    settled = _kept(least.select(fact.key, F.col("least.is_new").alias("is_new"), "old"), scratch("settled"))
    stay = settled.filter(~F.col("is_new")).select(fact.key)
    displaced = settled.filter("is_new").select(fact.key, "old.*").select(*raw_columns)
    changed = newest.join(stay, fact.key, "left_anti").select(*raw_columns)

    touched = _values(fact.placed(changed), fact.by) | _values(fact.placed(displaced), fact.by)
    replaced, same = _replaced(spark, root, live.tables[fact.table], fact.by, touched)
    # Spread as joined rows, which are narrower than fact rows.
    after = fact.complete(spread(fact.join(fact.placed(changed)), *fact.by))
    stays = versions.read_folders(spark, root, fact.table, replaced, after.schema).select(*after.columns)
    if replaced:
        stays = spread(stays.join(displaced.select(fact.key), fact.key, "left_anti"), *fact.by)
        after = stays.unionByName(after)
    if touched:
        write_partitioned(after, draft.path(fact.table), fact.by, already_spread=True)
        tables[fact.table] = same + _new(spark, root, draft, fact.table)
    rows = versions.read_folders(spark, root, fact.table, _new(spark, root, draft, fact.table), after.schema)

    if fact.summaries and touched:
        schemas = write_states(rows, fact, draft)
        by = [f"by_{c}" for c in fact.by]
        for name in schemas:
            tables[name] = _replaced(spark, root, live.tables[name], by, touched)[1] + _new(spark, root, draft, name)
        summaries = merge_summaries(spark, root, fact, tables, schemas)
        write_tables({draft.path(name): df for name, df in summaries.items()})
        tables |= {name: [draft.folder(name)] for name in summaries}

    tables[fact.survivors] += added
    _merge_pieces(spark, root, fact, draft, tables, newest.schema, width, n_buckets)
    return Fold(tables, rows, len(touched), changed.count())


def _merge_pieces(
    spark: SparkSession, root: str, fact: Fact, draft: Draft, tables: dict[str, list[str]], schema: T.StructType, width: int | None, buckets: int
) -> None:
    """Write buckets of survivors anew that are in PIECES pieces, a row per key."""
    _, leaves = _replaced(spark, root, tables[fact.survivors], [BUCKET], set())
    pieces = Counter(_partition(leaf, [BUCKET]) for leaf in leaves)
    full = {bucket for bucket, n in pieces.items() if n >= PIECES}
    if not full:
        return
    own = f"{draft.folder(fact.survivors)}-merged"
    at, others = _replaced(spark, root, leaves, [BUCKET], full)
    rows = versions.read_folders(spark, root, fact.survivors, at, schema).drop(BUCKET)
    raw_columns = [c for c in rows.columns if c != COPIES]
    rest = [*fact.order_by, *(c for c in raw_columns if c != fact.key and c not in fact.order_by)]
    least = rows.groupBy(fact.key).agg(F.sum(COPIES).alias(COPIES), F.min(F.struct(*rest)).alias("least"))
    merged_rows = least.select(*(F.col(c) if c == fact.key else F.col(f"least.{c}").alias(c) for c in raw_columns), COPIES)
    write_survivors(merged_rows, fact, f"{root}/{own}", width, buckets)
    tables[fact.survivors] = [*others, own]


def _kept(df: DataFrame, path: str) -> DataFrame:
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _new(spark: SparkSession, root: str, draft: Draft, table: str) -> list[str]:
    """This version's own folder of a table, if it holds any partition."""
    has_rows = any("=" in n for n in storage.names(spark, draft.path(table)))
    return [draft.folder(table)] if has_rows else []
