"""From a raw frame to one clean row per entity and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annalist.functions.dates import parse_date, parse_int
from annalist.spec import EntitySpec


def conform_types(raw: DataFrame, dates: Sequence[str] = (), ints: Sequence[str] = ()) -> DataFrame:
    """Parse text columns; unreadable text becomes NULL instead of failing the job."""
    parsed = {c: parse_date(c) for c in dates} | {c: parse_int(c) for c in ints}
    return raw.withColumns(parsed) if parsed else raw


def keyed_rows(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rows that have both an entity key and a date."""
    return df.filter(F.col(spec.key).isNotNull() & F.col(spec.date).isNotNull())


def quarantine(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """The rows ``keyed_rows`` leaves out, with the reason."""
    reason = F.when(F.col(spec.key).isNull(), "missing key").otherwise("missing date")
    return df.filter(F.col(spec.key).isNull() | F.col(spec.date).isNull()).withColumn(
        "quarantine_reason", reason
    )


def require_day(df: DataFrame, spec: EntitySpec) -> None:
    """Refuse a date column finer than a day: the bound on rows per entity rests on it."""
    kind = dict(df.dtypes)[spec.date]
    if kind != "date":
        raise ValueError(f"{spec.date} must be a date, not {kind}; parse or cast it first")


def one_row_per_day(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Deduplicate by (entity, day), keeping the row that ``spec.tie_break`` puts first.

    ``row_number() = 1`` lets Spark drop losers inside each map task before the shuffle, and
    the shuffle key includes the day, so neither a busy entity nor a much re-delivered
    entity-day travels whole to one task.  After this step an entity has at most one row per
    calendar day, which bounds every later per-entity window.
    """
    require_day(df, spec)
    order = spec.tie_order() or [F.col(spec.date)]
    w = Window.partitionBy(spec.key, spec.date).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def conform_snapshot(
    raw: DataFrame, spec: EntitySpec, dates: Sequence[str] = (), ints: Sequence[str] = ()
) -> DataFrame:
    """Parse, drop rows without key or date, deduplicate."""
    return one_row_per_day(keyed_rows(conform_types(raw, dates, ints), spec), spec)


def first_seen(df: DataFrame, spec: EntitySpec, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per entity: its attributes on the first day it was seen.

    Needs no join and no earlier deduplication: the order (day, tie-break) picks the same row,
    and rows that cannot win are dropped before the only shuffle.
    """
    w = Window.partitionBy(spec.key).orderBy(F.col(spec.date), *spec.tie_order())
    first = keyed_rows(df, spec).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return first.select(*columns) if columns else first.drop("_rn")


def first_date_per_key(df: DataFrame, spec: EntitySpec) -> DataFrame:
    return df.groupBy(spec.key).agg(F.min(spec.date).alias("first_snapshot_date"))


def history_and_latest(df: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """Split into the rows before the latest date and the rows on it.

    The latest date is a scalar subquery that reads only the date column.  The check for an
    empty input reads at most one row.
    """
    if df.limit(1).isEmpty():
        raise ValueError("no rows to split")
    latest = df.agg(F.max(date).alias("latest")).scalar()
    return df.filter(F.col(date) < latest), df.filter(F.col(date) == latest)
