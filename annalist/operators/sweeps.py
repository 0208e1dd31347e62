"""Questions over intervals answered by sweeping their ends: work by versions, not by days or pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "effective_start_date", "effective_end_date"


def headcount_from_versions(
    dim: DataFrame, counts: Column, until: Column, by: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Entities per calendar day (and group) whose version of the day satisfies ``counts``.

    Every version adds one on its first day and takes one away behind its last; the changes of a day
    are summed over all versions, and running sums of these sums are the headcount. So the versions are
    read once and combined in the map tasks, and what is left for the running sum and the calendar has
    at most one row per group and day, however many entities there are. Days run from the first change
    of a group to ``until``; a day without change repeats the headcount before it.
    """
    kept = dim.where(counts & F.col(START).isNotNull()).select(*by, START, END)
    ends = F.array(
        F.struct(F.col(START).alias("_day"), F.lit(1).alias("_step")),
        F.struct(F.date_add(END, 1).alias("_day"), F.lit(-1).alias("_step")),
    )
    # The open end is no day of the calendar, so nothing is taken away behind it.
    open_ = F.col("_step").eqNullSafe(-1) & (F.col("_day").isNull() | (F.col("_day") > until))
    changes = kept.select(*by, F.inline(ends)).where(~open_ & (F.col("_day") <= until))
    per_day = changes.groupBy(*by, "_day").agg(F.sum("_step").alias("_step"))
    w = Window.partitionBy(*by).orderBy("_day")
    runs = per_day.select(
        *by, "_day",
        F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("headcount"),
        F.coalesce(F.date_sub(F.lead("_day").over(w), 1), until).alias("_last"),
    )
    return runs.select(F.explode(F.sequence("_day", "_last")).alias(date), *by, "headcount")


def overlapping_pairs(dim: DataFrame, key: str) -> DataFrame:
    """(key, versions, overlapping_pairs): how many pairs of an entity's versions share a day, where any do.

    Of m versions m(m-1)/2 pairs, less those that are apart; two versions are apart when one ends before
    the other starts, so every start counts the ends before it. Starts and ends are first counted per
    entity and day, mostly in the map tasks: a damaged table may repeat an entity without limit, the
    window over it holds at most two rows a calendar day, and no pair is ever formed. Rows without key
    or dates, or that end before they start, are left out; ``version_checks`` reports them.
    """
    proper = dim.where(F.col(key).isNotNull() & (F.col(START) <= F.col(END)))
    days = F.array(
        F.struct(F.col(START).alias("_day"), F.lit(1).alias("_starts"), F.lit(0).alias("_ends")),
        F.struct(F.col(END).alias("_day"), F.lit(0).alias("_starts"), F.lit(1).alias("_ends")),
    )
    per_day = proper.select(key, F.inline(days)).groupBy(key, "_day").agg(F.sum("_starts").alias("_starts"), F.sum("_ends").alias("_ends"))
    before = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.col("_starts") * F.coalesce(F.sum("_ends").over(before), F.lit(0))
    per_key = per_day.withColumn("_apart", apart).groupBy(key).agg(F.sum("_starts").alias("versions"), F.sum("_apart").alias("_apart"))
    pairs = F.col("versions") * (F.col("versions") - 1)
    found = per_key.select(key, "versions", (F.floor(pairs / 2) - F.col("_apart")).cast("long").alias("overlapping_pairs"))
    return found.where("overlapping_pairs > 0")
