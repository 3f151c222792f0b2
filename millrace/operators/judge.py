"""One marked pass over raw rows: deduplication and rules decided once, written once.

Every raw row is written with what cleaning makes of it, and fact, rejects, step counts and
audits are read from there. Rows whose key occurs once never shuffle:

1. Keys are counted, narrow and merged per task. Those that repeat set bits in a map of FILTER_BITS
   bits by their hash; it has at most 8 MB whatever the data, so it goes to every task.
2. One pass over the raw rows writes those whose bit is not set as they will stay, and puts
   the others aside, each with a number of its own. Rows that only share a bit are among them.
3. Of those put aside the least row of each key is found, merged per task first, so that a key
   with much of the table sends one row per task. It is written whole beside the others.
4. The rest of those put aside are surplus. They were written as such, and are told from the least
   rows by their numbers, which no two rows share, only when somebody asks for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.clean import COPIES
from millrace.operators.rules import Rule, first_broken
from millrace.sources.readers import read_parquet

FILTER_BITS = 1 << 26
_CHUNK = 1 << 15  # bits of one `bitmap_construct_agg`

SURPLUS, REASON, STATE, ROW = "is_surplus", "reason", "__state", "__row"
KEPT, REJECTED, ASIDE = "kept", "rejected", "aside"


def _bit(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(chunk, bits): the bits of all keys that occur more than once, null keys among them."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES)).filter(F.col(COPIES) > 1)
    bit = counted.select(_bit(keys).alias("bit"))
    return bit.groupBy(F.floor(F.col("bit") / _CHUNK).alias("chunk")).agg(
        F.bitmap_construct_agg(F.pmod("bit", F.lit(_CHUNK))).alias("bits")
    )


def _is_set(bits: Column, position: Column) -> Column:
    """One bit of a bitmap; false where there is no map."""
    one = F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    byte = F.conv(F.hex(one), 16, 10).cast("int")
    within = F.pmod(position, F.lit(8)).cast("int")
    return F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), within)) != 0, F.lit(False))


def may_repeat(df: DataFrame, keys: Sequence[str], repeated: DataFrame, column: str) -> DataFrame:
    """Flag rows whose key repeats; a few others, too, where the hash of their key meets that of one that does."""
    bit = _bit(keys)
    # At most FILTER_BITS / _CHUNK rows of 4 KB.
    chunks = F.broadcast(repeated.select(F.col("chunk").alias("__chunk"), F.col("bits").alias("__bits")))
    joined = df.join(chunks, F.floor(bit / _CHUNK) == F.col("__chunk"), "left")
    return joined.withColumn(column, _is_set(F.col("__bits"), F.pmod(bit, F.lit(_CHUNK)))).drop("__chunk", "__bits")


def write_judged(
    raw: DataFrame,
    rules: Sequence[Rule],
    path: str,
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    readable: Rule | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Write every row of ``raw`` with ``__copies``, ``is_surplus`` and ``reason``; read it back.

    ``reason`` is the name of the first rule broken; rules may ask for ``is_surplus``. With
    ``keys``, one row per key is no surplus, as in `clean.keep_one`, and carries the number of
    rows it stands for; the others, and rows that are not ``readable``, have no such number.
    Rows that are not readable go before anything else. ``scratch`` is for the map of keys.
    """
    spark = raw.sparkSession
    raw_columns = raw.columns
    no_row = F.lit(None).cast("long")
    # Cut off here, so that what is unreadable takes no part in counting keys.
    can_read = readable.holds() if readable else F.lit(True)
    if keys:
        marks = repeated_keys(raw.filter(can_read), keys)
        if scratch:
            marks.write.mode("overwrite").parquet(scratch)
            marks = read_parquet(spark, scratch, schema=marks.schema)
        marked = may_repeat(raw, keys, marks, "__aside")
    else:
        marked = raw.withColumn("__aside", F.lit(False))
    aside = F.col("__aside")
    once = marked.withColumn("__aside", aside & can_read).withColumns(
        {SURPLUS: aside, COPIES: F.when(can_read & ~aside, F.lit(1).cast("long"))}
    )
    broken = first_broken(rules)
    reason = F.when(~can_read, F.lit(readable.name)).otherwise(broken) if readable else broken
    settled_state = F.when(F.col(REASON).isNull(), KEPT).otherwise(REJECTED)
    written = once.withColumn(REASON, reason).withColumns(
        {
            ROW: F.when(aside, F.monotonically_increasing_id()).otherwise(no_row),
            STATE: F.when(aside, ASIDE).otherwise(settled_state),
        }
    )
    columns = [*raw_columns, COPIES, SURPLUS, REASON, ROW, STATE]
    first = written.select(*columns)
    _write_scratch(first, path, "overwrite")
    everything = read_parquet(spark, path, schema=first.schema)
    if not keys:
        return everything.drop(ROW)
    put_aside = everything.filter(F.col(STATE) == ASIDE)
    rest = [*order_by, *(c for c in raw_columns if c not in keys and c not in order_by)]
    least = put_aside.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES), F.min(F.struct(*rest, ROW)).alias("__least"))
    chosen = least.select(
        *(F.col(c) if c in keys else F.col(f"__least.`{c}`").alias(c) for c in raw_columns),
        COPIES,
        F.lit(False).alias(SURPLUS),
        F.col(f"__least.{ROW}").alias(ROW),
    )
    _write_scratch(chosen.withColumn(REASON, broken).withColumn(STATE, settled_state).select(*columns), path, "append")
    everything = read_parquet(spark, path, schema=first.schema)  # with the files that have come
    settled = everything.filter(F.col(STATE) != ASIDE)
    numbers = settled.filter(F.col(ROW).isNotNull()).select(ROW)
    # As constants where they are, so that who asks for kept rows, or one of each, never joins.
    turned_down = any(rule.condition == f"not {SURPLUS}" for rule in rules)
    surplus = put_aside.join(numbers, ROW, "left_anti").withColumns(
        {COPIES: no_row, STATE: F.lit(REJECTED) if turned_down else settled_state}
    )
    return settled.select(*columns).unionByName(surplus.select(*columns)).drop(ROW)


def _write_scratch(rows: DataFrame, path: str, mode: str) -> None:
    rows.write.mode(mode).option("compression", "zstd").partitionBy(STATE).parquet(path)


def rows_as_read(raw: DataFrame, path: str) -> DataFrame:
    """The raw rows as they came, from where `write_judged` put them; joins nothing."""
    schema = T.StructType([*raw.schema.fields, T.StructField(ROW, T.LongType()), T.StructField(STATE, T.StringType())])
    written = read_parquet(raw.sparkSession, path, schema=schema)
    return written.filter((F.col(STATE) == ASIDE) | F.col(ROW).isNull()).select(*raw.columns)


def kept_rows(judged: DataFrame) -> DataFrame:
    """Rows that pass; only their folder is read."""
    return judged.filter(F.col(STATE) == KEPT).drop(COPIES, SURPLUS, REASON, STATE)


def rejected_rows(judged: DataFrame) -> DataFrame:
    """Rows that do not, with the reason."""
    return judged.filter(F.col(STATE) == REJECTED).drop(COPIES, SURPLUS, STATE)


def one_each(judged: DataFrame) -> DataFrame:
    """One row per key, whatever else is wrong with it, with ``__copies``."""
    return judged.filter(F.col(COPIES).isNotNull()).drop(SURPLUS, REASON, STATE)


def all_rows(judged: DataFrame) -> DataFrame:
    """The raw rows as they came."""
    return judged.drop(COPIES, SURPLUS, REASON, STATE)
