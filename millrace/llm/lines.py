"""Line dedup: of a line that many documents repeat, one document keeps its copies.

Every line long enough gives one narrow row: two hashes of its key, document, position. The
rows are range-partitioned by hash and document (largest first) and sorted, so the copies of
a line follow one another and a line that holds a third of the corpus spans many partitions.
Each partition streams its runs of equal hashes: first document of the run, number of
documents in it. A run that touches a partition's edge may go on next door; the edges, two
per partition at most, are added up and joined back. What comes out per document is a bitmap
of kept lines (64-bit words, only those with a dropped line). Text moves once, to meet its
bitmap.

Defined cases: a null text is one empty line; rows that share a doc_id are one document when
documents are counted, and each keeps its own text; a null doc_id is a document below all
others; an empty table gives no rows; other columns pass through. Two keys are taken for the
same when both 64-bit hashes agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.tables import kept, lower_ascii

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
#: Space and the control characters 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def keep_bitmaps(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """doc_id, text_hash, n_dropped and keep: a map of word number to 64 keep bits.

    Words that are not in the map keep all their lines; documents that keep everything have
    no row.
    """
    lines = (
        docs.select("doc_id", _text_hash().alias("text_hash"), F.posexplode(_lines()).alias("pos", "line"))
        .select("doc_id", "text_hash", "pos", F.btrim("line", F.lit(BLANKS)).alias("line"))
        .where(F.length("line") >= min_length)
        .select("doc_id", "text_hash", "pos", lower_ascii(F.col("line")).alias("key"))
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            "doc_id",
            "text_hash",
            "pos",
        )
    )
    newest = F.col("doc_id").desc_nulls_last()
    placed = kept(
        lines.repartitionByRange("h1", "h2", newest)
        .sortWithinPartitions("h1", "h2", newest, "pos")
        .withColumn("part", F.spark_partition_id()),
        "line-hashes",
    )
    run = Window.partitionBy("part", "h1", "h2").orderBy(newest)
    whole = Window.partitionBy("part", "h1", "h2")
    runs = (
        placed.withColumn("rank", F.dense_rank().over(run))
        .withColumn("run_doc", F.first("doc_id").over(run))
        .withColumn("run_docs", F.max("rank").over(whole).cast("long"))
    )
    hashes = F.struct("h1", "h2")
    ends = placed.groupBy("part").agg(F.min(hashes).alias("low"), F.max(hashes).alias("high"))
    # Two hashes per partition at most, each with one row per partition it spans.
    edge = ends.select(F.explode(F.array("low", "high")).alias("edge")).select("edge.*").distinct()
    across = (
        placed.join(F.broadcast(edge), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2")
        .agg(
            F.max("doc_id").alias("edge_doc"),
            F.count_distinct("doc_id").alias("some_docs"),
            F.max(F.when(F.col("doc_id").isNull(), 1).otherwise(0)).alias("null_docs"),
        )
        .select("h1", "h2", "edge_doc", (F.col("some_docs") + F.col("null_docs")).alias("edge_docs"))
    )
    n_docs = F.coalesce("edge_docs", "run_docs")
    keeper = F.when(F.col("edge_docs").isNull(), F.col("run_doc")).otherwise(F.col("edge_doc"))
    dropped = (
        runs.join(F.broadcast(across), ["h1", "h2"], "left")
        .where((n_docs >= min_documents) & ~F.col("doc_id").eqNullSafe(keeper))
        .select("doc_id", "text_hash", "pos")
        .distinct()  # the same row twice drops the same lines
    )
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = dropped.groupBy("doc_id", "text_hash", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits"), F.count("*").alias("n")
    )
    return words.groupBy("doc_id", "text_hash").agg(
        F.sum("n").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("keep")))).alias("keep"),
    )


def drop_repeated_lines(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """All columns of ``docs`` with the kept text, plus n_lines and n_dropped."""
    maps = keep_bitmaps(docs, min_length, min_documents).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_dropped", "keep"
    )
    held = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # A struct keeps columns of the caller apart from those added here, whatever their names.
    left = docs.select(
        F.struct(*held).alias("row"), F.col("doc_id").alias("_doc"), _text_hash().alias("_text_hash")
    )
    joined = left.join(
        maps, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left"
    )
    lines = F.split(F.coalesce("row.text", F.lit("")), "\n", -1)
    stays = F.expr(
        "array_join(filter(split(coalesce(row.text, ''), '\\n', -1), (line, i) -> "
        "(shiftright(coalesce(try_element_at(keep, cast(i div 64 as int)), -1L), i % 64) & 1L) = 1L), '\\n')"
    )
    text = F.when(F.col("keep").isNull(), F.col("row.text")).otherwise(stays)
    out = [text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in held]
    return joined.select(
        *out,
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return drop_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines
), often as (
  select k, max(doc_id) as keeper from keyed where length(k) >= 20
  group by k having count(distinct doc_id) >= 3
), marked as (
  select l.*, o.k is not null and l.doc_id <> o.keeper as gone
  from keyed l left join often o on l.k = o.k
)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""
