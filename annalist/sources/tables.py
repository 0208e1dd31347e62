"""Writing and listing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from annalist.sources.scratch import shuffles_removed


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    file_format: str = "parquet",
    location: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
    sort_by: Sequence[str] = (),
) -> int:
    """Write a table and return its number of new rows, counted during the write.

    ``bucket_by`` with ``buckets`` lays rows out by entity: later windows and joins on the
    entity then read the table without a shuffle.  The rows are shuffled to their buckets
    first, so there is one file per bucket instead of one per bucket and task.
    """
    rows = Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    if bucket_by and buckets:
        counted = counted.repartition(buckets, bucket_by)
    writer = counted.write.mode(mode).format(file_format)
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{name}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by, *sort_by)
    writer.saveAsTable(name)
    return rows.get["rows"]


def register_view(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Make ``df`` readable by name without copying data."""
    df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def write_csv(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str] = ()) -> None:
    """Export ``columns`` in this order with a header; rows are sorted over all part files."""
    out = df.select(*columns)
    if order:
        out = out.orderBy(*order)
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    with shuffles_removed(df.sparkSession):
        out.write.mode("overwrite").options(header=True, escape='"', **keep_blanks).csv(path)
