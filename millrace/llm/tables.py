"""Reading the inputs, and tables in the shared folder that cut lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import configure, fresh_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Letters outside A-Z that have a lower case; a text without them may use the fast `lower`.
OTHER_UPPER = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"


#: Rows in an Arrow batch; texts are long, and a batch is held by the JVM and by Python.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Later steps start from files that every executor can reach, so an executor that
    is lost costs only its own tasks, and a costly step runs once.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.when(text.rlike(OTHER_UPPER), F.translate(text, UPPER, LOWER)).otherwise(
        F.lower(text)
    )


def crc_bucket(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n
