"""One query per operator, over whole tables, for `__spark_entry__`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from millrace.llm import (
    decontaminate,
    infill,
    language,
    language_model,
    lines,
    near_text,
    packing,
    secrets,
    sentencepieces,
    shards,
    token_counts,
    vectors,
    whitening,
)
from millrace.llm.tables import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def over_documents(digest: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return digest(table(prepare(spark), sf_dir, "documents"))

    return run


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(prepare(spark), sf_dir, "embeddings"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(prepare(spark), sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_language_id": over_documents(language.digest),
    "op2_token_counts": over_documents(token_counts.digest),
    "op3_line_dedup": over_documents(lines.digest),
    "op4_secret_scan": over_documents(secrets.digest),
    "op5_lm_score": over_documents(language_model.digest),
    "op6_embedding_dedup": embedding_dedup,
    "op7_sentencepiece": over_documents(sentencepieces.digest),
    "op8_shards": over_documents(shards.digest),
    "op9_minhash_dedup": over_documents(near_text.digest),
    "op10_decontamination": decontamination,
    "op11_fill_in_middle": over_documents(infill.digest),
    "op12_packing": over_documents(packing.digest),
    "op13_embedding_whitening": embedding_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op3_line_dedup": lines.ORACLE,
    "op4_secret_scan": secrets.ORACLE,
    "op6_embedding_dedup": vectors.ORACLE,
    "op9_minhash_dedup": near_text.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
    "op11_fill_in_middle": infill.ORACLE,
}
