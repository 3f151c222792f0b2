"""Arrow batches in, Arrow batches out: the one place where operators run Python in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Text bytes handled at once inside a task; a longer text is a batch of its own.
CHUNK_BYTES = 8 * 1024 * 1024

#: Takes the texts (None for null) of a chunk; gives one list or Arrow array per added column.
Worker = Callable[[list], list]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes, one row at least."""
    for batch in batches:
        sizes = [len(t) if t is not None else 0 for t in _views(batch.column(text))]
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if len(sizes) > start:
            yield batch.slice(start)


def _views(column) -> Iterator:
    return (None if not v.is_valid else v.as_buffer() for v in column)


def add_columns(
    df: DataFrame,
    start_worker: Callable[[], Worker],
    added: str,
    text: str = "text",
    keep: list[str] | None = None,
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """``keep`` (default: all columns of ``df``) plus the columns that the worker computes.

    ``start_worker`` runs once per task. A column of ``df`` with the name of an added one
    gives way to it.
    """
    fields = T.StructType.fromDDL(added).fields
    names = {f.name for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([f for f in df.schema.fields if f.name in keep] + fields)
    arrow = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = start_worker()
        for batch in chunks(batches, text, limit):
            made = worker(batch.column(text).to_pylist())
            columns = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(made, arrow)]
            held = [n for n in batch.schema.names if n in keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in held] + columns, names=held + [f.name for f in fields]
            )

    ordered = df.select(*[f.name for f in schema.fields if f.name in keep], *([] if text in keep else [text]))
    return ordered.mapInArrow(run, schema)
