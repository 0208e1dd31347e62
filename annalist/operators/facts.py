"""Fact tables and the date dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions.dates import date_key
from annalist.operators.asof import as_of_versions
from annalist.spec import EntitySpec


def daily_fact(
    snapshot: DataFrame, spec: EntitySpec, attributes: Sequence[str], status: str, active: str
) -> DataFrame:
    """One row per entity and day with a 0/1 headcount flag (an unknown status counts 0)."""
    return snapshot.select(
        date_key(spec.date).alias("date_key"),
        spec.date,
        spec.key,
        *attributes,
        F.when(F.col(status) == active, 1).otherwise(0).alias("active_headcount_flag"),
    )


def reporting_fact(
    snapshot: DataFrame, spec: EntitySpec, manager: str, alias: str, attributes: Sequence[str] = ()
) -> DataFrame:
    """Child-to-manager edges, one per entity and day."""
    return snapshot.select(
        date_key(spec.date).alias("date_key"),
        spec.date,
        spec.key,
        F.col(manager).alias(alias),
        *attributes,
    )


def change_fact(events: DataFrame, spec: EntitySpec) -> DataFrame:
    pairs = [c for name in spec.tracked for c in (f"prev_{name}", name)]
    return events.select(date_key("event_date").alias("date_key"), "event_date", spec.key, *pairs)


def with_version_key(
    fact: DataFrame, dim: DataFrame, spec: EntitySpec, sk: str, date: str | None = None
) -> DataFrame:
    """Back-fill the surrogate key of the version valid on each fact row's date."""
    return as_of_versions(fact, dim, spec.key, date or spec.date, spec.key, [sk], one_row_per_day=True)


def date_dimension(bounds: DataFrame, first: Column | str, last: Column | str) -> DataFrame:
    """Calendar rows between two dates, given as aggregates over ``bounds``."""
    first = F.min(first) if isinstance(first, str) else first
    last = F.max(last) if isinstance(last, str) else last
    days = bounds.agg(first.alias("_first"), last.alias("_last")).select(
        F.explode(F.sequence("_first", "_last")).alias("date")
    )
    weekday = F.weekday("date") + 1
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.weekofyear("date").alias("iso_week"),
        (weekday >= 6).alias("is_weekend"),
        F.trunc("date", "month").alias("month_start"),
        F.last_day("date").alias("month_end"),
    )
