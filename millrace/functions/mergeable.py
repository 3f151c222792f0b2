"""Measures that can be kept as partial states and merged later.

A measure is one or more parts and an expression over them. Each part has an aggregate over
rows and one over such values, so a summary of a whole table is the merge of the summaries of
its pieces. Taken at once, the parts give the same SQL as `millrace.functions.measures`.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from millrace.functions import measures


@dataclass(frozen=True)
class Part:
    """``over_rows`` aggregates rows, ``over_parts`` (with ``{}`` for the column) such values."""

    over_rows: str
    over_parts: str = "sum({})"


@dataclass(frozen=True)
class Measure:
    """``final`` is SQL over the parts, written ``{0}``, ``{1}``, ...

    A distinct count has no such parts: its state is the values themselves, named by ``values_of``.
    """

    parts: tuple[Part, ...]
    final: str = "{0}"
    values_of: str | None = None

    @property
    def sql(self) -> str:
        if self.values_of:
            return f"count(distinct {self.values_of})"
        return self.final.format(*(part.over_rows for part in self.parts))


def count(column: str) -> Measure:
    return Measure((Part(f"count({column})"),))


def count_if(condition: str) -> Measure:
    return Measure((Part(f"count_if({condition})"),))


def total(column: str, scale: int = 2) -> Measure:
    """As `measures.total`; the state is the decimal sum, so merging is exact."""
    return Measure((_sum(column, scale),), "cast({0} as double)")


def mean(column: str, scale: int = 2) -> Measure:
    number = Part(f"count({measures.decimal(column, scale)})")
    return Measure((_sum(column, scale), number), measures.ratio("cast({0} as double)", "{1}"))


def _sum(column: str, scale: int) -> Part:
    return Part(f"try_sum({measures.decimal(column, scale)})", "try_sum({})")


def rounded(measure: Measure, digits: int) -> Measure:
    return replace(measure, final=measures.rounded(measure.final, digits))


def distinct(column: str) -> Measure:
    """Exact: merging needs every value once per piece."""
    return Measure((), values_of=column)


def approx_distinct(column: str, lg_registers: int = 12) -> Measure:
    """From HyperLogLog sketches of 2^lg_registers registers; the standard error is 1.04 / sqrt(registers)."""
    sketch = Part(f"hll_sketch_agg({column}, {lg_registers})", "hll_union_agg({})")
    return Measure((sketch,), "hll_sketch_estimate({0})")


def approximate(measured: Mapping[str, Measure], lg_registers: int = 12) -> dict[str, Measure]:
    """The same measures with sketches in place of exact distinct counts."""
    return {
        name: approx_distinct(m.values_of, lg_registers) if m.values_of else m for name, m in measured.items()
    }
