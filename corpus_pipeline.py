"""From raw documents to token ids, in five stages over the operators of `millrace.llm`.

1. language_id: texts whose language is not told with enough confidence, or that have no
   letter, go.
2. line_dedup: lines that three documents or more share stay in one of them.
3. minhash_dedup: of each class of near-duplicates the document with the least doc_id stays.
4. decontamination: documents that hold a window of a benchmark item go.
5. sentencepiece: whole texts become piece ids.

Each stage takes and returns rows of `documents`; the last adds ids and n_tokens. A text that
loses lines gets its new length in n_chars. Null texts go at stage 1. All columns of the caller
go through every stage as they are, whatever their names; where one is called ids or n_tokens,
the last stage puts an underscore after its own. An empty table goes through as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language, lines, near_text, sentencepieces
from millrace.llm.tables import prepare, table
from millrace.session import fresh_dir, scratch_scope


def _apart(docs: DataFrame, *used: str) -> DataFrame:
    """The caller's columns in one, so that none meets a name that an operator uses inside."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("caller")
    return docs.select(others, *used, "text")


def _as_before(found: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    back = {c: F.col("text") if c == "text" else F.col(f"caller.`{c}`") for c in docs.columns} | changed
    return found.select(*(back[c].alias(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = language.identify(_apart(docs), language.learn(docs.select("lang", "text")))
    return _as_before(found.where(~F.col("rejected")), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = lines.drop_repeated_lines(_apart(docs, "doc_id"))
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("caller.n_chars"))
    return _as_before(found, docs, n_chars=length)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_text.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.find_contamination(_apart(docs), table(spark, sf_dir, "benchmark"))
    return _as_before(found.where(~F.col("contaminated")), docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = sentencepieces.encode(_apart(docs))
    n_tokens = F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long")
    before = [F.col("text") if c == "text" else F.col(f"caller.`{c}`").alias(c) for c in docs.columns]
    return found.select(
        *before, F.col("ids").alias(_free("ids", docs)), n_tokens.alias(_free("n_tokens", docs))
    )


def _free(name: str, docs: DataFrame) -> str:
    while name in docs.columns:
        name += "_"
    return name


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Models, minhashes and tokenizers have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage has written on its way goes when it is done."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
