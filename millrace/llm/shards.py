"""Contiguous shards of near equal byte size, from global prefix sums.

Rows are put in the order of their id by a range partitioning. Each partition's total is
summed up over the partitions before it (as many rows as partitions, no text), and that start
plus the running sum inside the partition is the row's place in the corpus. Cutting the
corpus at equal byte targets gives the shards; a row goes where its middle byte lies, so each
shard is off its target by less than its two outermost rows.

Only ids, sizes and checksums are shuffled, never the texts.

Defined cases: a null text has size 1 and the checksum of an empty text; a null id comes
first; rows that share an id lie side by side, ordered by checksum and size; an empty table
gives no rows; with fewer rows than shards, or one row larger than a target, some shards stay
empty. Extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.tables import kept

LAW = "bytes"


def assign_shards(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (place in the shard, from 0) per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # Written once, because the partition a row falls in must be the same for the totals and
    # for the running sums.
    order = [F.col("doc_id").asc_nulls_first(), "text_crc32", "size"]
    placed = kept(
        rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shards"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    starts = (
        placed.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(everything).alias("all_bytes"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Twice the middle byte against twice the total keeps the division in whole numbers.
    middle = 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")
    cut = F.least(
        F.lit(n_shards - 1).cast("decimal(38,0)"),
        F.floor(middle.cast("decimal(30,0)") * n_shards / (2 * F.col("all_bytes"))),
    )
    sharded = (
        placed.withColumn("upto", F.sum("size").over(running))
        .withColumn("nth", F.row_number().over(inside).cast("long"))
        .join(starts, "part")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            cut.cast("int").alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("place"),
        )
    )
    sharded = kept(sharded, "sharded")
    firsts = sharded.groupBy("shard").agg(F.min("place").alias("first_place"))
    return sharded.join(firsts, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("place") - F.col("first_place")).alias("slot"),
    )


def digest(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    return assign_shards(docs, n_shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: crc32 is the one thing DuckDB lacks; the rest of the row is compared.
ORACLE = None
