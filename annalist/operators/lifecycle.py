"""Spells of a status: leave and return, termination and rehire.

The input is the daily snapshot (one row per entity and day), so per-entity windows are
bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annalist.spec import EntitySpec


def status_spells(snapshot: DataFrame, spec: EntitySpec, status: str) -> DataFrame:
    """Runs of equal status with their start and the start and status of the next run."""
    w = Window.partitionBy(spec.key).orderBy(spec.date)
    starts = (
        snapshot.select(spec.key, spec.date, F.struct(status).alias("_now"))
        .withColumn("_was", F.lag("_now").over(w))
        .filter(~F.col("_now").eqNullSafe(F.col("_was")))
    )
    return starts.select(
        spec.key,
        F.col("_now")[status].alias(status),
        F.col(spec.date).alias("spell_start"),
        F.lead(spec.date).over(w).alias("next_start"),
        F.lead(F.col("_now")[status]).over(w).alias("next_status"),
    )


def leave_spells(
    snapshot: DataFrame, spec: EntitySpec, status: str, leave: str = "on_leave", active: str = "active"
) -> DataFrame:
    """Each leave: when it began, its length once it ended, and whether work followed."""
    spells = status_spells(snapshot, spec, status).filter(F.col(status) == leave)
    return spells.select(
        spec.key,
        F.col("spell_start").alias("leave_start"),
        F.date_sub("next_start", 1).alias("leave_end"),
        F.date_diff("next_start", "spell_start").alias("leave_days"),
        F.coalesce(F.col("next_status") == active, F.lit(False)).alias("returned"),
        "next_status",
    )


def rehire_windows(
    snapshot: DataFrame, spec: EntitySpec, status: str, gone: str = "terminated", active: str = "active"
) -> DataFrame:
    """Each termination with the next day the entity was active again, if any."""
    w = Window.partitionBy(spec.key).orderBy(F.col("spell_start").desc())
    later = w.rowsBetween(Window.unboundedPreceding, -1)
    back = F.min(F.when(F.col(status) == active, F.col("spell_start"))).over(later)
    return (
        status_spells(snapshot, spec, status)
        .withColumn("_back", back)
        .filter(F.col(status) == gone)
        .select(
            spec.key,
            F.col("spell_start").alias("terminated_on"),
            F.col("_back").alias("rehired_on"),
            F.date_diff("_back", "spell_start").alias("days_away"),
        )
    )
