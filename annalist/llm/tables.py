"""Reading the tables the queries of this subpackage run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that travel between Spark and Python at once, where the session does not say.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let texts travel in smaller batches than Spark's 10,000 rows, unless the session asks for a size.

    Both sides hold a whole batch outside the heap, each task for itself.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hex_long(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of the MD5 of a text as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")
