"""Reading raw extracts under a column contract."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BOM = "\ufeff"
CSV_OPTIONS = {"header": True, "sep": ",", "quote": '"', "escape": '"'}
COLUMNAR = ("delta", "parquet", "orc")
FORMATS = ("auto", "csv", *COLUMNAR)


class ContractError(ValueError):
    """A source lacks required columns."""


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    return df


def strip_bom(df: DataFrame) -> DataFrame:
    """Remove a byte order mark in front of the first column's name."""
    first = df.columns[0] if df.columns else ""
    clean = first.removeprefix(BOM)
    if clean == first or clean in df.columns:
        return df
    return df.withColumnRenamed(first, clean)


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def listed_files(spark: SparkSession, path: str) -> list:
    """Status of the data files behind a path, a folder or a pattern; hidden and empty ones are left out."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for match in fs.globStatus(where) or []:
        found += fs.listStatus(match.getPath()) if match.isDirectory() else [match]
    return [f for f in found if f.isFile() and f.getLen() and not f.getPath().getName().startswith(("_", "."))]


def _header(spark: SparkSession, file) -> tuple[str, ...]:
    """Column names in the first line of a CSV file."""
    jvm, path = spark._jvm, file.getPath()
    conf = spark._jsc.hadoopConfiguration()
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = (reader.readLine() or "").removeprefix(BOM)
    finally:
        reader.close()
    return tuple(next(csv.reader([line], quotechar=CSV_OPTIONS["quote"]), ()))


def read_csv(
    spark: SparkSession,
    path: str,
    multiline: bool = False,
    required: Sequence[str] = (),
    source_column: str | None = None,
) -> DataFrame:
    """CSV with a header, every column as text; empty fields are NULL.

    Each file is read under its own header and files are put together by column name, so neither a
    changed order nor an added column moves values; every file must have the ``required`` columns.
    The headers are one line of each file; files of equal headers are one scan.

    Types are never guessed: identifiers such as tax numbers have leading zeros, and guessing
    costs a full extra scan.  ``multiline`` allows line breaks inside quotes, at the price of
    reading each file in one task.  ``source_column`` names a column for the path of each row's file.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in listed_files(spark, path):
        by_header.setdefault(_header(spark, file), []).append(file.getPath().toString())
    if not by_header:
        raise ContractError(f"no data files in {path}")
    parts = []
    for header, files in by_header.items():
        missing = [c for c in required if c not in header]
        if missing or len(set(header)) < len(header):
            problem = f"missing required columns: {missing}" if missing else "a column twice"
            raise ContractError(f"{problem} in {len(files)} files, such as {files[0]}")
        part = spark.read.options(**CSV_OPTIONS).schema(text_schema(header)).option("multiLine", multiline).csv(files)
        parts.append(part.select("*", F.col("_metadata.file_path").alias(source_column)) if source_column else part)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def csv_candidates(path: str) -> list[str]:
    """The path itself and, for a folder, the CSV files in it."""
    if "*" in path or path.lower().endswith(".csv"):
        return [path]
    return [path, f"{path.rstrip('/')}/*.csv"]


def _formats_found(spark: SparkSession, path: str) -> list[str]:
    """The columnar format of a path, judged by the names of all its files.

    Files of several formats beside each other are refused: a reader of one would fail on the rest.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    kinds, delta = set(), False
    for match in fs.globStatus(where) or []:
        if not match.isDirectory():
            kinds.add(_kind(match.getPath().getName()))
            continue
        delta |= fs.exists(spark._jvm.org.apache.hadoop.fs.Path(match.getPath(), "_delta_log"))
        files = fs.listFiles(match.getPath(), True)
        while files.hasNext():
            name = files.next().getPath().getName()
            if not name.startswith(("_", ".")):
                kinds.add(_kind(name))
    if delta:
        return ["delta"]
    if len(kinds) > 1:
        raise ContractError(f"files of several formats in {path}: {sorted(kinds)}")
    return [k for k in kinds if k in COLUMNAR]


def _kind(name: str) -> str:
    return next((f for f in ("parquet", "orc") if name.lower().endswith(f".{f}")), "csv")


def read_raw(
    spark: SparkSession,
    path: str,
    required: Sequence[str],
    source_format: str = "auto",
    multiline: bool = False,
    source_column: str | None = None,
) -> DataFrame:
    """Read ``path`` in the named format, or in the first format that fulfils the contract.

    ``auto`` tries the columnar format the path holds and then CSV.  When nothing fits, the error
    lists every attempt.  ``source_column`` names a column for the path of each row's file.
    """

    def columnar(fmt: str) -> DataFrame:
        df = spark.read.format(fmt).load(path)
        if source_column:
            df = df.select("*", F.col("_metadata.file_path").alias(source_column))
        return require_columns(strip_bom(df), required)

    if source_format not in FORMATS:
        raise ValueError(f"source_format must be one of: {', '.join(FORMATS)}")
    if source_format == "auto":
        attempts = [(f, path) for f in _formats_found(spark, path)]
    elif source_format == "csv":
        attempts = []
    else:
        return columnar(source_format)
    attempts += [("csv", p) for p in csv_candidates(path)]

    errors = []
    for fmt, candidate in attempts:
        try:
            if fmt == "csv":
                return read_csv(spark, candidate, multiline, required, source_column)
            return columnar(fmt)
        except Exception as e:  # noqa: BLE001 - every reader fails in its own way
            errors.append(f"{fmt} {candidate}: {str(e).splitlines()[0]}")
    raise ContractError(f"no readable source with the required columns; tried {'; '.join(errors)}")


def with_ingest_columns(df: DataFrame, source: str | None = None) -> DataFrame:
    """Add ``ingest_ts`` and ``source_file``: the one given, the one read with the rows
    (``source_column="source_file"``), or that of each row's file where ``df`` is a plain scan."""
    if source is None and "source_file" in df.columns:
        return df.withColumn("ingest_ts", F.current_timestamp())
    origin = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return df.withColumns({"ingest_ts": F.current_timestamp(), "source_file": origin})
