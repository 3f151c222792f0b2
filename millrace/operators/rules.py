"""Named conditions, shared by audit, cleaning, quarantine and checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.columns import first_match, flag


@dataclass(frozen=True)
class Rule:
    """A name and a SQL condition on one row."""

    name: str
    condition: str

    def column(self) -> Column:
        """The bare condition, fit for a filter that should reach the scan."""
        return F.expr(self.condition)

    def holds(self) -> Column:
        """True or false, never null: a null condition does not hold."""
        return flag(self.column())


# Counted with other rules, gives the number of rows in the same pass.
ALL_ROWS = Rule("rows", "true")


def first_broken(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that does not hold; null where all of them hold."""
    return first_match([(~rule.holds(), rule.name) for rule in rules], None)


def any_holds(rules: Sequence[Rule]) -> Column:
    return reduce(or_, [rule.holds() for rule in rules])
