"""Profiles of a table before cleaning. Each is one scan with partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.measures import percent
from millrace.operators.rules import Rule, any_holds


def _long_form(wide: DataFrame, keep: Sequence[str], names: Sequence[str], key: str, value: str):
    return wide.unpivot(list(keep), list(names), key, value)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count, null_pct) of every column, in one aggregate."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *(F.count_if(F.col(c).isNull()).alias(c) for c in columns),
    )
    return _long_form(wide, ["__rows"], columns, "column_name", "null_count").select(
        "column_name",
        "null_count",
        F.expr(percent("null_count", "__rows")).alias("null_pct"),
    )


def null_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null cells over all columns together."""
    return null_profile(df, columns).agg(F.sum("null_count").alias("null_cells"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """(rows, distinct_keys, duplicates); a null key counts as one value.

    Counting the groups keeps the null group, which a distinct count leaves out.
    Copies of a key are merged before the shuffle.
    """
    counted = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__copies"))
        .agg(
            F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("distinct_keys"),
        )
    )
    return counted.withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, matches): how many rows meet each condition."""
    wide = df.agg(*(F.count_if(r.column()).alias(r.name) for r in rules))
    return _long_form(wide, [], [r.name for r in rules], "rule", "matches")


def value_range(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row with the least and greatest value of each column.

    ``columns`` maps a column to the noun used in ``earliest_`` and ``latest_``.
    """
    bounds: list[Column] = []
    for column, noun in columns.items():
        bounds += [F.min(column).alias(f"earliest_{noun}"), F.max(column).alias(f"latest_{noun}")]
    return df.agg(*bounds)


def distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, rows) for several code columns in one pass."""
    as_text = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    return (
        as_text.unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def issue_summary(df: DataFrame, counted: Sequence[Rule], any_of: Sequence[Rule]) -> DataFrame:
    """How much of a table has issues, counted in two ways.

    ``total_issues`` adds up the counts of ``counted``, so a row with two issues
    counts twice. ``rows_with_issue`` is the exact number of rows that meet at
    least one condition of ``any_of``.
    """
    wide = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(any_holds(any_of)).alias("rows_with_issue"),
        *(F.count_if(r.column()).alias(f"__{r.name}") for r in counted),
    )
    issues = " + ".join(f"__{r.name}" for r in counted)
    return _issue_columns(wide.withColumn("total_issues", F.expr(issues)))


def _issue_columns(wide: DataFrame) -> DataFrame:
    return wide.select(
        "total_rows",
        "total_issues",
        F.expr(percent("total_issues", "total_rows", 1)).alias("issue_pct"),
        (F.col("total_rows") - F.col("total_issues")).alias("clean_rows_estimate"),
        "rows_with_issue",
        (F.col("total_rows") - F.col("rows_with_issue")).alias("clean_rows"),
    )


class Profile:
    """All audits of a table from one aggregate over it.

    Rows are counted once, by the values of the code columns together, with null counts, rule
    counts, ends of ranges and rows with an issue as partial sums. That table has a row per
    combination that occurs; every result below adds it up again. It is written to ``path``,
    so the raw table is read once whatever is asked for. Meant for columns of few values: the
    counts stay right for any, but combine less.
    """

    def __init__(
        self,
        df: DataFrame,
        path: str,
        rules: Sequence[Rule] = (),
        codes: Sequence[str] = (),
        ranges: dict[str, str] | None = None,
        any_of: Sequence[Rule] = (),
    ) -> None:
        self.columns, self.codes = list(df.columns), list(codes)
        self.rules, self.ranges = list(rules), dict(ranges or {})
        # Numbers in place of names: the columns of a raw table may have any name.
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(self.columns)]
        met = [F.count_if(r.column()).alias(f"rule_{i}") for i, r in enumerate(self.rules)]
        ends = []
        for i, c in enumerate(self.ranges):
            ends += [F.min(c).alias(f"low_{i}"), F.max(c).alias(f"high_{i}")]
        with_issue = F.count_if(any_holds(any_of) if any_of else F.lit(False)).alias("with_issue")
        by = [F.col(f"`{c}`").cast("string").alias(f"code_{i}") for i, c in enumerate(self.codes)]
        base = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), with_issue, *nulls, *met, *ends)
        base.write.mode("overwrite").parquet(path)
        self.base = df.sparkSession.read.schema(base.schema).parquet(path)

    @staticmethod
    def _sum(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    def nulls(self) -> DataFrame:
        """As `null_profile`."""
        names = [f"null_{i}" for i in range(len(self.columns))]
        wide = self.base.agg(self._sum("rows").alias("__rows"), *(self._sum(n).alias(c) for n, c in zip(names, self.columns)))
        return _long_form(wide, ["__rows"], self.columns, "column_name", "null_count").select(
            "column_name", "null_count", F.expr(percent("null_count", "__rows")).alias("null_pct")
        )

    def rule_counts(self) -> DataFrame:
        """As `rule_counts`."""
        wide = self.base.agg(*(self._sum(f"rule_{i}").alias(r.name) for i, r in enumerate(self.rules)))
        return _long_form(wide, [], [r.name for r in self.rules], "rule", "matches")

    def value_range(self) -> DataFrame:
        """As `value_range`."""
        bounds: list[Column] = []
        for i, noun in enumerate(self.ranges.values()):
            bounds += [F.min(f"low_{i}").alias(f"earliest_{noun}"), F.max(f"high_{i}").alias(f"latest_{noun}")]
        return self.base.agg(*bounds)

    def distribution(self) -> DataFrame:
        """As `distribution`, of the code columns."""
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"code_{i}").alias("value")) for i, c in enumerate(self.codes)]
        return (
            self.base.select("rows", F.inline(F.array(*pairs)))
            .groupBy("column_name", "value")
            .agg(F.sum("rows").alias("rows"))
        )

    def issue_summary(self, counted: Sequence[Rule]) -> DataFrame:
        """As `issue_summary`; ``counted`` are among the rules of the profile."""
        at = {r.name: i for i, r in enumerate(self.rules)}
        issues = reduce(add, [self._sum(f"rule_{at[r.name]}") for r in counted], F.lit(0))
        wide = self.base.agg(
            self._sum("rows").alias("total_rows"), issues.alias("total_issues"), self._sum("with_issue").alias("rows_with_issue")
        )
        return _issue_columns(wide)
