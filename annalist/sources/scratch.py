"""Intermediate tables on storage that survives the loss of an executor."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Of releases and of tables of a scope: fingerprints are texts of hexadecimal digits, of which the default codec saves nothing.
CODEC = "zstd"
_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[str] = []
_prefixes: list[str] = []
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
_lock = threading.Lock()
_removing: dict[str, tuple[int, str | None]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session.

    ``spark.checkpoint.dir`` (or a checkpoint directory already set on the context) names it.
    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="annalist-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/annalist/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    if (inside := _passing.get()) is not None:
        inside.append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that this thread writes inside are removed at the end, however it ends.

    Scopes may be nested; a table belongs to the innermost one in which it is written.
    """
    inside: list[str] = []
    token = _passing.set(inside)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in inside:
            discard(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query run inside go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, those of all steps side by side.
    The setting of the session is put back when the last of its threads is done.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        depth, before = _removing.get(session, (0, None))
        if not depth:
            before = spark.conf.get(_SHUFFLES, None)
            spark.conf.set(_SHUFFLES, "true")
        _removing[session] = depth + 1, before
    try:
        yield
    finally:
        with _lock:
            depth, before = _removing.pop(session)
            if depth > 1:
                _removing[session] = depth - 1, before
            elif before is None:
                spark.conf.unset(_SHUFFLES)
            else:
                spark.conf.set(_SHUFFLES, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and fixes non-repeatable values."""
    return written(df, label)[0]


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``materialize`` that also gives the table's path, for `discard`."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    return _put(df, path), path


def _put(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with shuffles_removed(spark):
        df.write.parquet(path, compression=None if _passing.get() is None else CODEC)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """``materialize`` of what ``build`` returns; scratch tables that it wrote on its way go."""
    path = scratch_path(spark, label)
    with passing(spark):
        return _put(build(), path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove one scratch table that nothing reads any more."""
    if path in _written:
        _written.remove(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize_counting(df: DataFrame, label: str, condition: str) -> tuple[DataFrame, int]:
    """``materialize`` that also counts, during the write, the rows satisfying ``condition``."""
    return written_counting(df, label, condition)[:2]


def written_counting(df: DataFrame, label: str, condition: str) -> tuple[DataFrame, int, str]:
    """``materialize_counting`` that also gives the table's path, for `discard`."""
    seen = Observation()
    rows, path = written(df.observe(seen, F.count_if(F.expr(condition)).alias("rows")), label)
    return rows, seen.get["rows"], path


def scratch_tables(prefix: str) -> str:
    """Mark the catalog's tables of this prefix as scratch."""
    _prefixes.append(prefix)
    return prefix


def drop_scratch(spark: SparkSession) -> None:
    """Remove every scratch table this process wrote; results that read them end with them."""
    while _prefixes:
        prefix = _prefixes.pop()
        for table in spark.catalog.listTables():
            if table.name.startswith(prefix):
                kind = "VIEW" if table.tableType in ("VIEW", "TEMPORARY") else "TABLE"
                spark.sql(f"DROP {kind} IF EXISTS `{table.name}`")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _written:
        target = jvm.org.apache.hadoop.fs.Path(_written.pop())
        target.getFileSystem(conf).delete(target, True)
