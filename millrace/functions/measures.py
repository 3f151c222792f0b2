"""Aggregate measures as SQL text, usable in ``F.expr`` and in ``spark.sql``.

Sums run over decimals, not doubles: a double sum depends on the order in which
partial results meet, so it changes from run to run once tasks are retried or
rebalanced. ``scale`` is the number of decimals the input carries.
"""

from __future__ import annotations


def total(column: str, scale: int = 2) -> str:
    """Order-independent sum of ``column``, as a double.

    Values that no decimal holds (NaN, infinity, 22 digits and more) are left out, here
    and in ``mean``, and never fail the job; the checks of a domain report them.
    """
    return f"cast(try_sum({decimal(column, scale)}) as double)"


def mean(column: str, scale: int = 2) -> str:
    """Exact sum over the number of values in it; null for no values."""
    return ratio(total(column, scale), f"count({decimal(column, scale)})")


def decimal(column: str, scale: int) -> str:
    """``column`` as what sums add up; null where no decimal holds it."""
    return f"try_cast({column} as decimal(28,{scale}))"


def ratio(numerator: str, denominator: str) -> str:
    """Quotient that is null, not an error, for an empty denominator."""
    return f"try_divide({numerator}, {denominator})"


def rounded(measure: str, digits: int) -> str:
    return f"round({measure}, {digits})"


def percent(part: str, whole: str, digits: int = 2) -> str:
    return rounded(ratio(f"100.0D * {part}", whole), digits)
