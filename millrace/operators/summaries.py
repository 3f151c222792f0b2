"""Grouped summaries as data: keys, measures and an optional row filter.

A summary can also be kept as partial states, one set per piece of its table, which are
merged into the summary. When pieces change, only their states are made anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.mergeable import Measure, approximate


@dataclass(frozen=True)
class Summary:
    """``keys`` and ``measures`` map an output column to SQL text."""

    keys: Mapping[str, str]
    measures: Mapping[str, str | Measure] = field(default_factory=dict)
    where: str | None = None

    def approximate(self, lg_registers: int = 12) -> Summary:
        """The same summary with distinct counts estimated from sketches."""
        return replace(self, measures=approximate(self.measures, lg_registers))


def summarise(df: DataFrame, spec: Summary) -> DataFrame:
    if spec.where:
        df = df.filter(spec.where)
    keys = [F.expr(text).alias(name) for name, text in spec.keys.items()]
    measures = {
        name: F.expr(m.sql if isinstance(m, Measure) else m).alias(name) for name, m in spec.measures.items()
    }
    values = {name: m.values_of for name, m in spec.measures.items() if isinstance(m, Measure) and m.values_of}
    if len(values) != 1 or len(measures) == 1:
        return df.groupBy(*keys).agg(*measures.values())
    # Apart, because in one aggregate each distinct value takes the states of all measures through the shuffle.
    [(counted, column)] = values.items()
    plain = df.groupBy(*keys).agg(*(m for name, m in measures.items() if name != counted))
    distinct = df.select(*keys, F.expr(column).alias("__value")).distinct()
    counts = distinct.groupBy(*spec.keys).agg(F.count("__value").alias(counted))
    both = plain.unionByName(counts, allowMissingColumns=True)
    # One row of each for a group, null keys included, which a join would treat apart.
    return both.groupBy(*spec.keys).agg(*(F.first(name, ignorenulls=True).alias(name) for name in measures))


def _key_columns(spec: Summary) -> list[Column]:
    return [F.expr(text).alias(f"key_{name}") for name, text in spec.keys.items()]


def _piece(df: DataFrame, spec: Summary, by: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    rows = df.filter(spec.where) if spec.where else df
    return rows, [*(F.col(c).alias(f"by_{c}") for c in by), *_key_columns(spec)]


def partial_states(df: DataFrame, spec: Summary, by: Sequence[str]) -> DataFrame:
    """A row per piece (the columns ``by``) and group, with the parts of all measures.

    Columns are ``by_*``, ``key_*``, ``rows`` and ``<measure>__<part>``.
    """
    rows, grouped = _piece(df, spec, by)
    parts = [
        F.expr(part.over_rows).alias(f"{name}__{i}")
        for name, m in spec.measures.items()
        for i, part in enumerate(m.parts)
    ]
    return rows.groupBy(*grouped).agg(F.count(F.lit(1)).alias("rows"), *parts)


def distinct_values(df: DataFrame, spec: Summary, by: Sequence[str]) -> DataFrame:
    """What exact distinct counts are merged from: every value once per piece, group and measure."""
    rows, grouped = _piece(df, spec, by)
    counted = {name: m.values_of for name, m in spec.measures.items() if m.values_of}
    pairs = [
        F.struct(F.lit(name).alias("measure"), F.expr(column).cast("string").alias("value"))
        for name, column in counted.items()
    ]
    if not pairs:
        pairs = [F.struct(F.lit("").alias("measure"), F.lit(None).cast("string").alias("value"))]
    return rows.select(*grouped, F.inline(F.array(*pairs))).filter("value is not null").distinct()


def merged(states: DataFrame, values: DataFrame, spec: Summary) -> DataFrame:
    """The summary, from the states and distinct values of all pieces.

    One aggregate over both: a join on the keys would have to treat null keys apart.
    """
    keys = [f"key_{name}" for name in spec.keys]
    together = states.drop(*(c for c in states.columns if c.startswith("by_"))).unionByName(
        values.select(*keys, "measure", "value"), allowMissingColumns=True
    )
    aggregates = []
    for name, m in spec.measures.items():
        if m.values_of:
            text = f"count(distinct if(measure = '{name}', value, null))"
        else:
            over = [part.over_parts.format(f"`{name}__{i}`") for i, part in enumerate(m.parts)]
            text = m.final.format(*over)
        aggregates.append(F.expr(text).alias(name))
    grouped = together.groupBy(*keys).agg(*aggregates)
    return grouped.select(*(F.col(f"key_{name}").alias(name) for name in spec.keys), *spec.measures)
