"""Checks on a loaded table and the verdict they add up to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.audit import duplicate_keys, rule_counts
from millrace.operators.rules import Rule


def _verdicts(failures: DataFrame) -> DataFrame:
    return failures.withColumn(
        "verdict", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL")
    )


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(check, failures, verdict); a rule states what a failing row looks like."""
    return _verdicts(
        rule_counts(df, rules).select(
            F.col("rule").alias("check"), F.col("matches").alias("failures")
        )
    )


def null_rules(columns: Sequence[str]) -> list[Rule]:
    """One rule per required column."""
    return [Rule(f"null_{column}", f"{column} is null") for column in columns]


def check_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return check_rules(df, null_rules(columns))


def check_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    return _verdicts(
        duplicate_keys(df, key).select(
            F.lit(name).alias("check"), F.col("duplicates").alias("failures")
        )
    )


def gate(checks: DataFrame) -> DataFrame:
    """One row: number of checks, failures in all, and the run status they give."""
    return checks.agg(
        F.count(F.lit(1)).alias("checks"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("failures"),
    ).withColumn("status", F.when(F.col("failures") == 0, "SUCCESS").otherwise("FAILED"))
