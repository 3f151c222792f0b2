"""Joins of a fact table to its dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A dimension has several rows for one key, so a join would multiply facts."""


def require_unique(dimension: DataFrame, key: str) -> int:
    """Raise unless every key of the dimension occurs once; return the number of rows.

    Rows without a key join with nothing, so any number of them is allowed.
    """
    found = (
        dimension.groupBy(key)
        .agg(F.count(F.lit(1)).alias("__copies"))
        .agg(
            F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("__copies") - 1)), F.lit(0)).alias(
                "surplus"
            ),
        )
        .first()
    )
    if found["surplus"]:
        raise DuplicateKeyError(f"{found['surplus']} surplus rows for key {key!r}")
    return found["rows"]


def lookup(df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join that adds ``columns`` of the dimension; unmatched rows get nulls.

    No broadcast is forced. Spark broadcasts a dimension whose size, estimated or
    measured at run time, is below ``spark.sql.autoBroadcastJoinThreshold``; a
    larger one is joined by shuffle, where AQE splits the partitions of hot keys.
    """
    return df.join(dimension.select(key, *columns), on=key, how="left")


SALT = "__salt"


def hot_keys(df: DataFrame, key: str, share: float = 1 / 64) -> list:
    """Keys that hold at least ``share`` of the rows: no more than 1 / share of them."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    # One job: the counts go through one shuffle, which both sides read, and rows are read once.
    rows = counted.agg(F.sum("__rows").alias("__all"))
    found = counted.crossJoin(rows).filter(F.col("__rows") >= F.lit(share) * F.col("__all"))
    # Rows without a key are left out here; a filter in one of the sides would make two shuffles of them.
    return [r[key] for r in found.select(key).collect() if r[key] is not None]


def lookup_hot(
    df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str], hot: Sequence, salts: int = 64
) -> DataFrame:
    """As `lookup`, with what is known of the keys in the plan rather than left to run time.

    Rows without a key match nothing and go round the join. Rows of ``hot`` keys (see `hot_keys`)
    are dealt to ``salts`` partitions by the task they come from, which is the same when a task
    runs again; the few dimension rows of those keys are repeated for each salt.
    """
    salted = F.when(F.col(key).isin(list(hot)), F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(0)
    repeated = F.when(F.col(key).isin(list(hot)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    if not hot:
        salted, repeated = F.lit(0), F.array(F.lit(0))
    right = dimension.select(key, *columns).filter(F.col(key).isNotNull()).withColumn(SALT, F.explode(repeated))
    left = df.filter(F.col(key).isNotNull()).withColumn(SALT, salted)
    joined = left.join(right, on=[key, SALT], how="left").drop(SALT)
    types = dict(dimension.dtypes)
    without = df.filter(F.col(key).isNull()).select("*", *(F.lit(None).cast(types[c]).alias(c) for c in columns))
    return joined.unionByName(without)


def orphans(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the dimension does not have."""
    return df.join(dimension.select(key), on=key, how="left_anti")


def orphan_counts(df: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """(dimension, orphan_rows, orphan_keys).

    Rows are counted by key first, so the join sees a hot key once.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    return (
        orphans(per_key, dimension, key)
        .agg(
            F.coalesce(F.sum("__rows"), F.lit(0)).alias("orphan_rows"),
            F.count(key).alias("orphan_keys"),
        )
        .select(F.lit(name).alias("dimension"), "orphan_rows", "orphan_keys")
    )
