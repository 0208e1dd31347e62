"""Arriving files: each is ingested once, re-delivered rows are dropped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from annalist.sources.readers import CSV_OPTIONS


def arriving_files(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    file_format: str = "csv",
    files_per_batch: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """A stream over the files of a folder."""
    reader = spark.readStream.format(file_format).schema(schema)
    if file_format == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def ingest_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a parquet folder and stop.

    The checkpoint remembers which files were read and the file sink commits each batch once,
    so a rerun or a restart after a failure neither skips nor repeats a file.
    """
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity Spark gives a stream with its checkpoint; a fresh checkpoint is another run."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Everything ``ingest_fresh`` has landed, with ``run`` and ``batch``; None before the first batch."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run=*/batch=*/_SUCCESS")):
        return None
    return spark.read.option("basePath", path).parquet(f"{path}/run=*/batch=*")


def ingest_fresh(
    stream: DataFrame, path: str, checkpoint: str, columns: Sequence[str], date: str
) -> StreamingQuery:
    """Append what has arrived and was not delivered before, however late, and stop.

    A row counts as delivered before when one with the same ``columns`` is stored. Put the row's
    fingerprint among them: a correction of the same day differs in it and passes, to be resolved
    later by the tie-break of the snapshot. Nothing is forgotten and nothing is dropped for being
    late, so there is no time limit to choose: each micro-batch is compared with what is stored for
    the days it touches, which the driver lists, and storage is partitioned by day (``date``, one of ``columns``).

    A batch that is repeated after a failure replaces its own folder and is not compared with it. A
    fresh checkpoint is another run beside the earlier ones.
    """
    if date not in columns:
        raise ValueError(f"{date} must be among the columns that identify a row")

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        run = run_id(spark, checkpoint)
        fresh = batch.dropDuplicates(list(columns))
        before = stored_rows(spark, path)
        if before is not None:
            # The days themselves, not their range: one old row must not read all days since.
            days = [r[0] for r in batch.select(date).distinct().collect()]
            known = F.col(date).isin([d for d in days if d is not None])
            if None in days:
                known = known | F.col(date).isNull()
            other = (F.col("run") != run) | (F.col("batch") < number)
            before = before.where(other & known).select(*[F.col(c).alias(f"_s_{c}") for c in columns])
            same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in columns]
            fresh = fresh.join(before, reduce(and_, same), "left_anti")
        fresh.write.mode("overwrite").partitionBy(date).parquet(f"{path}/run={run}/batch={number}")

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
