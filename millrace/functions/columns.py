"""Row-level column builders shared by the two domains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_seconds(start: str, end: str) -> Column:
    """Whole seconds between two timestamps."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def first_match(cases: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """Value of the first case whose condition is true, else the default."""
    (condition, value), *others = cases
    chain = F.when(condition, value)
    for condition, value in others:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def bucket(column: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by the first edge the value lies below; the last label takes the rest.

    A null value compares with no edge, so it takes the last label too.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    cases = [(F.col(column) < edge, name) for edge, name in zip(edges, labels)]
    return first_match(cases, labels[-1])


def label(column: str, names: Mapping[int, str], default: str) -> Column:
    """Code to name, with a default for codes (and nulls) not listed."""
    return first_match([(F.col(column) == code, name) for code, name in names.items()], default)


def band(column: str, bands: Mapping[str, tuple[int, int]], default: str) -> Column:
    """Name of the first inclusive range that holds the value."""
    cases = [(F.col(column).between(low, high), name) for name, (low, high) in bands.items()]
    return first_match(cases, default)


def flag(condition: Column) -> Column:
    """True where the condition is true; false where it is false or null."""
    return F.coalesce(condition, F.lit(False))


def year_is(column: str, year: int) -> str:
    """Predicate text for one calendar year.

    Written as a half-open range, because a range reaches the Parquet reader
    and ``year(column) = y`` does not.
    """
    return f"{column} >= date'{year:04d}-01-01' and {column} < date'{year + 1:04d}-01-01'"
