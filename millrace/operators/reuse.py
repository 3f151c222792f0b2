"""Share one computed table between several outputs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Cache for the length of a block, from before its first action.

    Blocks that do not fit in memory go to disk, and lost ones are recomputed.
    For a table too large to hold in the cluster, write it and read it back.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()
