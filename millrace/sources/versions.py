"""Tables that become visible together: written aside, checked, then switched to at once.

    <root>/<table>/version=<id>/...    what one run wrote
    <root>/_versions/<number>.json     the folders that make up each table, from one run on

The manifest of the highest number is live. It appears whole or not at all, and nothing that an
older one names is touched, so readers see one set of tables, and a run that fails or dies
anywhere leaves the set before it. A table may be put together from folders of several runs: a
reload replaces some partitions of a fact and names the others as they are. What no kept
manifest names, of dead runs too, goes with `tidy`.

One writer at a time is meant; of two that start from the same version, the second to publish
gets an error and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.sources import storage

FOLDER = "_versions"
COLUMN = "version"


class NothingPublished(LookupError):
    """There is no live version, or the table is not part of it."""


@dataclass(frozen=True)
class Manifest:
    """``tables``: name -> folders below the root, each a version of it or partitions of one."""

    number: int
    tables: Mapping[str, Sequence[str]]
    facts: Mapping[str, Any] = field(default_factory=dict)  # what the writer wants to keep with it


def _manifest_path(root: str, number: int) -> str:
    return f"{root}/{FOLDER}/{number:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    found = storage.names(spark, f"{root}/{FOLDER}")
    return [int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith(".")]


def _read_manifest(spark: SparkSession, root: str, number: int) -> Manifest:
    held = json.loads(storage.read_text(spark, _manifest_path(root, number)))
    return Manifest(number, held["tables"], held["facts"])


def live(spark: SparkSession, root: str) -> Manifest | None:
    """The manifest that readers go by; None before anything was published."""
    numbers = _numbers(spark, root)
    return _read_manifest(spark, root, numbers[-1]) if numbers else None


def read(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType | None = None,
    manifest: Manifest | None = None,
) -> DataFrame:
    """A table of a version, by default of the live one."""
    manifest = manifest or live(spark, root)
    if manifest is None or table not in manifest.tables:
        raise NothingPublished(f"{table} at {root}")
    return read_folders(spark, root, table, manifest.tables[table], schema)


def read_folders(
    spark: SparkSession, root: str, table: str, folders: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Folders of one table as one frame; partition columns come from the folder names."""
    if schema is not None:
        schema = T.StructType([*schema.fields, T.StructField(COLUMN, T.StringType())])
    if not folders:
        if schema is None:
            raise NothingPublished(f"{table} at {root} has no folder to take a schema from")
        return spark.createDataFrame([], schema).drop(COLUMN)
    reader = spark.read.option("basePath", f"{root}/{table}")
    reader = reader.schema(schema) if schema is not None else reader
    return reader.parquet(*(f"{root}/{folder}" for folder in folders)).drop(COLUMN)


def partitions(spark: SparkSession, root: str, folder: str, depth: int) -> list[str]:
    """The partition folders ``depth`` levels below a folder; the folder itself for 0."""
    found = [folder]
    for _ in range(depth):
        found = [
            f"{at}/{name}" for at in found for name in storage.names(spark, f"{root}/{at}") if "=" in name
        ]
    return found


class Draft:
    """A version in the making. Nothing of it is visible until `publish`."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root
        self.before = live(spark, root)
        self.number = self.before.number + 1 if self.before else 1
        self.id = f"{self.number:012d}-{uuid.uuid4().hex[:12]}"

    def folder(self, table: str) -> str:
        """Where this version's own part of a table goes, below the root."""
        return f"{table}/{COLUMN}={self.id}"

    def path(self, table: str) -> str:
        return f"{self.root}/{self.folder(table)}"

    def publish(self, tables: Mapping[str, Sequence[str]], **facts: Any) -> Manifest:
        """Switch readers to these tables; the one step that anybody else can see."""
        text = json.dumps({"tables": {k: list(v) for k, v in tables.items()}, "facts": facts})
        storage.write_new(self.spark, _manifest_path(self.root, self.number), text)
        return Manifest(self.number, tables, facts)

    def discard(self, tables: Sequence[str]) -> None:
        for table in tables:
            storage.delete_folder(self.spark, self.path(table))


def tidy(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Drop what the last ``keep`` manifests do not name, and older manifests; returns the folders.

    For times without a writer: what a run has written and not published yet would go as well.
    Readers of a version have until it is no longer among those kept.
    """
    numbers = _numbers(spark, root)
    kept, old = numbers[-keep:], numbers[:-keep]
    named = {f for n in kept for folders in _read_manifest(spark, root, n).tables.values() for f in folders}
    for number in old:
        storage.delete_folder(spark, _manifest_path(root, number))
    dropped = []
    for table in storage.names(spark, root):
        if table.startswith(("_", ".")):
            continue
        for name in storage.names(spark, f"{root}/{table}"):
            folder = f"{table}/{name}"
            if name.startswith(f"{COLUMN}=") and folder not in named:
                dropped += _drop_unnamed(spark, root, folder, named)
    return dropped


def _drop_unnamed(spark: SparkSession, root: str, folder: str, named: set[str]) -> list[str]:
    """Delete a folder, or, where something below it is named, what else lies there."""
    if not any(n.startswith(f"{folder}/") for n in named):
        storage.delete_folder(spark, f"{root}/{folder}")
        return [folder]
    dropped = []
    for name in storage.names(spark, f"{root}/{folder}"):
        at = f"{folder}/{name}"
        if "=" in name and at not in named:
            dropped += _drop_unnamed(spark, root, at, named)
    return dropped
