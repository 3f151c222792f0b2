"""SQL reports over a loaded table."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Report:
    """SQL text over the view named ``view``."""

    view: str
    sql: str

    def run(self, df: DataFrame) -> DataFrame:
        # A name of its own: reports on several facts may run at once.
        own = f"{self.view}_{uuid.uuid4().hex}"
        df.createTempView(own)
        try:
            return df.sparkSession.sql(re.sub(rf"\b{self.view}\b", own, self.sql))
        finally:
            df.sparkSession.catalog.dropTempView(own)


def top(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows of an order; every task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)
