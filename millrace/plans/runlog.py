"""The record of one run: a single row of nested structs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.writers import append_json

#: The check that every table read back has the rows that went out.
ALTERED = "tables_altered"

_COUNTS = T.MapType(T.StringType(), T.LongType())

_STEP = T.StructType(
    [
        T.StructField("step_no", T.IntegerType()),
        T.StructField("step", T.StringType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("rows_removed", T.LongType()),
        T.StructField("removed_pct", T.DoubleType()),
    ]
)

_SOURCE = T.StructType(
    [
        T.StructField("source_format", T.StringType()),
        T.StructField("source_files", T.ArrayType(T.StringType())),
    ]
)

SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("run_timestamp", T.StringType()),
        T.StructField("ended_at", T.StringType()),
        T.StructField("stages_ended_at", T.MapType(T.StringType(), T.StringType())),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("extract", _COUNTS),
        T.StructField("extract_columns", _COUNTS),
        T.StructField("sources", T.MapType(T.StringType(), _SOURCE)),
        T.StructField(
            "transform",
            T.StructType(
                [
                    T.StructField("rows_before_cleaning", T.LongType()),
                    T.StructField("rows_after_cleaning", T.LongType()),
                    T.StructField("rows_after_filters", T.LongType()),
                    T.StructField("rows_removed", T.LongType()),
                    T.StructField("removal_rate_pct", T.DoubleType()),
                    T.StructField("final_columns", T.LongType()),
                    T.StructField("columns_added", T.LongType()),
                    T.StructField("steps", T.ArrayType(_STEP)),
                    T.StructField("quality_issues_found", _COUNTS),
                ]
            ),
        ),
        T.StructField(
            "load",
            T.StructType(
                [
                    T.StructField("rows", _COUNTS),
                    T.StructField("output_format", T.StringType()),
                    T.StructField("fact_path", T.StringType()),
                    T.StructField("summaries", T.ArrayType(T.StringType())),
                    T.StructField("partition_columns", T.ArrayType(T.StringType())),
                    T.StructField("partitions", T.LongType()),
                    T.StructField("root", T.StringType()),
                    T.StructField("version", T.LongType()),
                    T.StructField("published", T.BooleanType()),
                ]
            ),
        ),
        T.StructField(
            "quality_checks",
            T.StructType(
                [
                    T.StructField("failures", _COUNTS),
                    T.StructField("all_passed", T.BooleanType()),
                ]
            ),
        ),
    ]
)


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


@dataclass
class StageClock:
    """When a run began, and when each of its stages ended."""

    started: str = field(default_factory=now)
    ended: dict[str, str] = field(default_factory=dict)

    def end(self, stage: str) -> None:
        self.ended[stage] = now()


def source_of(df: DataFrame) -> dict:
    """Format and names of the files a frame is read from, as the driver has listed them."""
    files = sorted(unquote(f.rsplit("/", 1)[-1]) for f in df.inputFiles())
    kinds = {f.split(".")[-1] if "." in f else "" for f in files}
    return {"source_format": ", ".join(sorted(k for k in kinds if k)) or None, "source_files": files}


def _extracted(sources: Mapping[str, DataFrame]) -> dict:
    return {
        "extract_columns": {name: len(df.columns) for name, df in sources.items()},
        "sources": {name: source_of(df) for name, df in sources.items()},
    }


def _one_row(spark: SparkSession, row: dict) -> DataFrame:
    return spark.createDataFrame([row], SCHEMA).coalesce(1)


@contextmanager
def logged_failure(spark: SparkSession, name: str, clock: StageClock, root: str) -> Iterator[None]:
    """Record a run that raises, as FAILED and with the error, and let it raise."""
    try:
        yield
    except Exception as error:
        row = {
            "pipeline_name": name,
            "run_timestamp": clock.started,
            "ended_at": now(),
            "stages_ended_at": dict(clock.ended),
            "status": "FAILED",
            "error": f"{type(error).__name__}: {error}"[:2000],
        }
        append_json(_one_row(spark, row), f"{root}/run_log")
        raise


def reload_log(
    spark: SparkSession,
    *,
    name: str,
    failures: Mapping[str, int],
    sources: Mapping[str, DataFrame],
    loaded: Mapping[str, int],
    clock: StageClock,
    root: str,
    version: int,
    published: bool,
) -> DataFrame:
    """A log without the steps of cleaning: what a reload changed."""
    passed = not any(failures.values())
    row = {
        "pipeline_name": name,
        "run_timestamp": clock.started,
        "ended_at": now(),
        "stages_ended_at": dict(clock.ended),
        "status": "SUCCESS" if passed else "FAILED",
        **_extracted(sources),
        "load": {"rows": dict(loaded), "root": root, "version": version, "published": published},
        "quality_checks": {"failures": dict(failures), "all_passed": passed},
    }
    return _one_row(spark, row)


def run_log(
    spark: SparkSession,
    *,
    name: str,
    failures: Mapping[str, int],
    sources: Mapping[str, DataFrame],
    extract: Mapping[str, int],
    issues: Mapping[str, int],
    steps: Sequence[Row],
    last_cleaning_step: str,
    rows_final: int,
    columns_before: int,
    final_columns: int,
    clock: StageClock,
    fact_path: str,
    summaries: Sequence[str],
    loaded: Mapping[str, int],
    partition_columns: Sequence[str],
    partitions: int,
    root: str,
    version: int,
    published: bool,
) -> DataFrame:
    """Status and numbers come from the run; no check is taken as passed unseen.

    ``steps`` are the rows of ``step_counts``; cleaning ends with the step named, and what
    comes after it filters on derived columns.
    """
    passed = not any(failures.values())
    by_name = {step["step"]: step for step in steps}
    rows_before = by_name["all"]["rows_before"]
    removed = rows_before - rows_final
    row = {
        "pipeline_name": name,
        "run_timestamp": clock.started,
        "ended_at": now(),
        "stages_ended_at": dict(clock.ended),
        "status": "SUCCESS" if passed else "FAILED",
        "extract": dict(extract),
        **_extracted(sources),
        "transform": {
            "rows_before_cleaning": rows_before,
            "rows_after_cleaning": by_name[last_cleaning_step]["rows_after"],
            "rows_after_filters": rows_final,
            "rows_removed": removed,
            "removal_rate_pct": round(removed / rows_before * 100, 1) if rows_before else None,
            "final_columns": final_columns,
            "columns_added": final_columns - columns_before,
            "steps": [step.asDict() for step in steps],
            "quality_issues_found": dict(issues),
        },
        "load": {
            "rows": dict(loaded),
            "output_format": "Parquet",
            "fact_path": fact_path,
            "summaries": list(summaries),
            "partition_columns": list(partition_columns),
            "partitions": partitions,
            "root": root,
            "version": version,
            "published": published,
        },
        "quality_checks": {"failures": dict(failures), "all_passed": passed},
    }
    return _one_row(spark, row)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def log_entries(log: DataFrame) -> DataFrame:
    """(pipeline_name, entry, value): the counts of a log in long form."""
    transform = F.map_from_arrays(
        F.array(*(F.lit(n) for n in _TRANSFORM)),
        F.array(*(F.col(f"transform.{n}").cast("bigint") for n in _TRANSFORM)),
    )
    sections = {
        "extract": F.col("extract"),
        "extract_columns": F.col("extract_columns"),
        "transform": transform,
        "issues": F.col("transform.quality_issues_found"),
        "load": F.col("load.rows"),
        "partitions": F.create_map(F.lit("partitions"), F.col("load.partitions")),
        "checks": F.col("quality_checks.failures"),
    }
    return log.select(
        "pipeline_name",
        "status",
        F.explode(
            F.array(*(F.struct(F.lit(n).alias("section"), m.alias("m")) for n, m in sections.items()))
        ).alias("s"),
    ).select("pipeline_name", "status", "s.section", F.explode("s.m").alias("entry", "value"))


def log_steps(log: DataFrame) -> DataFrame:
    """(pipeline_name, step_no, step, rows_before, rows_after, rows_removed, removed_pct)."""
    return log.select("pipeline_name", F.inline("transform.steps"))


_TRANSFORM = (
    "rows_before_cleaning",
    "rows_after_cleaning",
    "rows_after_filters",
    "rows_removed",
    "final_columns",
    "columns_added",
)
