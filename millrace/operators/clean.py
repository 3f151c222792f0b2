"""Deduplication, rule filters, casts, quarantine and step counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.measures import percent
from millrace.operators.rules import Rule, first_broken

COPIES = "__copies"


def collapse(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key, with ``__copies``, the number of rows it stands for.

    The row kept is the least one, nulls first, in ``order_by`` and then in the
    other columns. That is a total order, so the choice does not depend on how
    the table is spread over tasks. The minimum is taken per task before the
    shuffle, so a key that holds much of the table sends one row per task.
    """
    keys = list(keys)
    order_by = list(order_by or ())
    rest = order_by + [c for c in df.columns if c not in keys and c not in order_by]
    kept = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(COPIES),
        # A struct with no fields is not allowed; a table may be all key.
        F.min(F.struct(*(rest or [F.lit(0).alias("__none")]))).alias("__kept"),
    )
    columns = [F.col(c) if c in keys else F.col(f"__kept.`{c}`").alias(c) for c in df.columns]
    return kept.select(*columns, COPIES)


def keep_one(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Drop all but one row per key; see ``collapse`` for which one stays."""
    return collapse(df, keys, order_by).drop(COPIES)


def mark_surplus(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    column: str = "is_surplus",
) -> DataFrame:
    """Keep every row and flag those ``keep_one`` would drop.

    All rows have to survive, so nothing can be merged before the shuffle, and a
    window over the key alone would put a hot key into one task. Two windows
    bound the groups: the first ranks within (key, input task), the second ranks
    only the first-round winners of a key, of which there is one per task. The
    task number is the same when a task is retried, and the outcome does not
    depend on it.
    """
    keys = list(keys)
    order_by = list(order_by or ())
    order = [
        F.col(c).asc_nulls_first()
        for c in order_by + [c for c in df.columns if c not in keys and c not in order_by]
    ] or [F.lit(0)]
    lane = df.withColumn("__lane", F.spark_partition_id())
    within = Window.partitionBy(*keys, "__lane").orderBy(*order)
    first_round = lane.withColumn("__first", F.row_number().over(within)).withColumn(
        "__final_lane", F.when(F.col("__first") == 1, -1).otherwise(F.col("__lane"))
    )
    across = Window.partitionBy(*keys, "__final_lane").orderBy(*order)
    return (
        first_round.withColumn("__final", F.row_number().over(across))
        .withColumn(column, ~((F.col("__first") == 1) & (F.col("__final") == 1)))
        .drop("__lane", "__first", "__final_lane", "__final")
    )


def require(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows for which every condition is true; a null condition drops the row."""
    for rule in rules:
        df = df.filter(rule.column())
    return df


def to_int(df: DataFrame, column: str) -> DataFrame:
    """Cast to int, cutting off decimals; values that do not fit become null."""
    return df.withColumn(column, F.col(column).try_cast("int"))


def set_aside(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with the name of the first one broken as ``reason``."""
    return df.withColumn("reason", first_broken(rules)).filter(F.col("reason").isNotNull())


def reason_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def step_counts(df: DataFrame, steps: Sequence[Rule], weight: str | None = None) -> DataFrame:
    """Rows before, after and removed for each step of a chain of rules, and in all.

    One aggregate counts the rows that get through the first, the first two, ...
    steps. ``weight`` names a column with the number of input rows a row stands
    for (the output of ``collapse``); the merge itself is then step 1.
    """
    counts = [F.sum(weight) if weight else F.count(F.lit(1))]
    names = ["input"]
    if weight:
        counts.append(F.count(F.lit(1)))
        names.append("duplicate_key")
    passed = F.lit(True)
    for step in steps:
        passed = passed & step.holds()
        counts.append(F.count_if(passed))
        names.append(step.name)
    # An ungrouped sum over no rows is null.
    wide = df.agg(*(F.coalesce(c, F.lit(0)).alias(f"n{i}") for i, c in enumerate(counts)))

    def row(number: int, name: str, before: str, after: str):
        return F.struct(
            F.lit(number).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(before).alias("rows_before"),
            F.col(after).alias("rows_after"),
        )

    rows = [row(i, names[i], f"n{i - 1}", f"n{i}") for i in range(1, len(names))]
    rows.append(row(len(names), "all", "n0", f"n{len(names) - 1}"))
    return (
        wide.select(F.inline(F.array(*rows)))
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
        .withColumn("removed_pct", F.expr(percent("rows_removed", "rows_before", 1)))
    )
