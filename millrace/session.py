"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from millrace.sources import storage

# Settings every session should have, local or cluster.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where an aggregate on the same key follows. Without
    # this, saving that one shuffle would leave the key's rows in a single task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Application id -> its folder below the scratch root.
_session_roots: dict[str, str] = {}
# Folders of the scopes that a thread has open, the innermost last.
_scopes = threading.local()


def shuffle_partitions(shuffled_bytes: int, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Shuffle partition count that keeps one partition near ``target_bytes``.

    Set it as ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``;
    AQE merges the ones that turn out small.
    """
    return max(8, math.ceil(shuffled_bytes / target_bytes))


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Give a session made elsewhere the settings the operators count on.

    ``input_bytes``, the size of what a load reads, sets how finely shuffles are cut.
    """
    for key, value in COMMON_CONF.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(shuffle_partitions(input_bytes)),
        )
    return spark


def local_session(cores: int | str = 8, name: str = "millrace", memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # Small inputs: let one file, and one rebalanced write, spread over all cores.
        .config("spark.sql.files.openCostInBytes", str(1024 * 1024))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(4 * 1024 * 1024))
    )
    for key, value in COMMON_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.gettempdir()


def _session_root(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    if application not in _session_roots:
        root = f"{scratch_root(spark)}/millrace-{uuid.uuid4().hex}"
        storage.make_temporary_folder(spark, root)
        _session_roots[application] = root
    return _session_roots[application]


def _open_scopes() -> list[str]:
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    return _scopes.open


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path not yet in use below the scratch root.

    It is dropped at the end of the innermost `scratch_scope` that this thread has open, or else
    when the driver's JVM ends.
    """
    scopes = _open_scopes()
    return f"{scopes[-1] if scopes else _session_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Drop what this thread writes to the scratch folder inside the block; results must be elsewhere by then."""
    own = f"{_session_root(spark)}/scope-{uuid.uuid4().hex}"
    _open_scopes().append(own)
    try:
        yield
    finally:
        _open_scopes().remove(own)
        storage.delete_folder(spark, own)
