"""Headcount, mix, movement and profile measures over the facts and the Type-2 dimension.

Every measure is a grouped aggregate with few groups compared to its input, so Spark combines
rows in the map tasks and shuffles only partial results, whatever the key distribution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.functions.dates import date_text, month_start

FLAG = "active_headcount_flag"


def _moved(*columns: str) -> Column:
    """Any of the columns is distinct from its previous value (NULL is a value)."""
    test = F.lit(False)
    for c in columns:
        test = test | ~F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    return test


def active_headcount(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    return fact.groupBy(*by).agg(F.sum(FLAG).alias("active_headcount"))


def count_on_latest_day(
    fact: DataFrame, date: str, condition: Column, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rows that satisfy ``condition`` on the latest day of the (already filtered) fact.

    With ``by``, on the latest day of each group.  Counts per day first and then takes the latest
    day's count: one scan, no second look at the fact for its last date.
    """
    per_day = fact.groupBy(*by, date).agg(F.count_if(condition).alias("_n"))
    return per_day.groupBy(*by).agg(F.max(date).alias(date), F.max_by("_n", date).alias(name))


def terminations(
    events: DataFrame, status: str = "status", gone: str = "terminated", by: Sequence[Column | str] = ()
) -> DataFrame:
    """Transitions into ``gone``; a first day on which someone is already gone is not one."""
    left = (F.col(status) == gone) & _moved(status) & ~F.col("is_initial")
    return events.groupBy(*by).agg(F.count_if(left).alias("total_terminations"))


def internal_moves(
    events: DataFrame, columns: Sequence[str], count_initial: bool = False, by: Sequence[Column | str] = ()
) -> DataFrame:
    """Events that changed any of ``columns``; first days count only on request."""
    moved = _moved(*columns)
    if not count_initial:
        moved = moved & ~F.col("is_initial")
    return events.groupBy(*by).agg(F.count_if(moved).alias("internal_moves"))


def headcount_by_month(fact: DataFrame, date: str, by: Sequence[str], method: str = "last") -> DataFrame:
    """Monthly headcount, which must not be summed over days.

    ``last``: headcount of the month's last delivered day.  ``average``: mean over the
    month's delivered days.  The fact is reduced to days and groups before anything else.
    """
    days = active_headcount(fact, [date, *by]).withColumn("month", month_start(date))
    if method == "average":
        delivered = days.groupBy("month").agg(F.count_distinct(date).alias("_days"))
        total = days.groupBy("month", *by).agg(F.sum("active_headcount").alias("_sum"))
        return total.join(delivered, "month").select(
            "month", *by, (F.col("_sum") / F.col("_days")).alias("active_headcount")
        )
    if method != "last":
        raise ValueError("method must be one of: last, average")
    last = F.max(date).over(Window.partitionBy("month"))
    return days.withColumn("_last", last).filter(F.col(date) == F.col("_last")).select(
        "month", F.col(date).alias("counted_on"), *by, "active_headcount"
    )


def headcount_rollup(fact: DataFrame, levels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Headcount with subtotals down a drill path; ``level`` is 0 for the most detailed rows.

    The fact is reduced to its detail groups first, so subtotal rows are made from groups
    instead of from every fact row.
    """
    detail = active_headcount(fact, [*by, *levels])
    if by:
        sets = [[*by, *levels[:n]] for n in range(len(levels), -1, -1)]
        grouped = detail.groupingSets(sets, *by, *levels)
    else:
        grouped = detail.rollup(*levels)
    return grouped.agg(
        F.grouping_id().cast("long").alias("level"),
        F.sum("active_headcount").alias("active_headcount"),
    )


# The names of event types, in the order in which they are tested.
EVENT_TYPES = (
    "hire",
    "rehire",
    "termination",
    "leave_start",
    "leave_return",
    "promotion",
    "demotion",
    "transfer",
    "relocation",
    "other",
)


def classify_events(
    events: DataFrame,
    bands: Sequence[str],
    status: str = "status",
    band: str = "salary_band",
    unit: Sequence[str] = ("org_unit", "team"),
    location: str = "location",
) -> DataFrame:
    """Add ``event_type``: the first test that holds, in the order of ``EVENT_TYPES``."""
    was, now = F.col(f"prev_{status}"), F.col(status)
    order = F.array(*[F.lit(b) for b in bands])
    step = F.array_position(order, F.col(band)) - F.array_position(order, F.col(f"prev_{band}"))
    known = F.array_contains(order, F.col(band)) & F.array_contains(order, F.col(f"prev_{band}"))
    kind = (
        F.when(F.col("is_initial"), "hire")
        .when((was == "terminated") & (now == "active"), "rehire")
        .when((now == "terminated") & _moved(status), "termination")
        .when((now == "on_leave") & _moved(status), "leave_start")
        .when((was == "on_leave") & (now == "active"), "leave_return")
        .when(known & (step > 0), "promotion")
        .when(known & (step < 0), "demotion")
        .when(_moved(*unit), "transfer")
        .when(_moved(location), "relocation")
        .otherwise("other")
    )
    return events.withColumn("event_type", kind)


def events_by_month(classified: DataFrame) -> DataFrame:
    return classified.groupBy(month_start("event_date").alias("month"), "event_type").agg(
        F.count(F.lit(1)).alias("events")
    )


def events_by_month_wide(classified: DataFrame) -> DataFrame:
    """One column per event type."""
    return (
        events_by_month(classified)
        .groupBy("month")
        .pivot("event_type", list(EVENT_TYPES))
        .agg(F.sum("events"))
        .na.fill(0, list(EVENT_TYPES))
    )


def mobility(
    events: DataFrame,
    bands: Sequence[str],
    band: str = "salary_band",
    unit: Sequence[str] = ("org_unit", "team"),
    role: str = "role_family",
    location: str = "location",
) -> DataFrame:
    """Movements per month.  One event may count in several columns."""
    order = F.array(*[F.lit(b) for b in bands])
    step = F.array_position(order, F.col(band)) - F.array_position(order, F.col(f"prev_{band}"))
    known = F.array_contains(order, F.col(band)) & F.array_contains(order, F.col(f"prev_{band}"))
    return (
        events.filter(~F.col("is_initial"))
        .groupBy(month_start("event_date").alias("month"))
        .agg(
            F.count_if(known & (step > 0)).alias("promotions"),
            F.count_if(known & (step < 0)).alias("demotions"),
            F.count_if(_moved(*unit)).alias("transfers"),
            F.count_if(_moved(role)).alias("role_changes"),
            F.count_if(_moved(location)).alias("relocations"),
        )
    )


def workforce_mix(fact: DataFrame, by: Sequence[str], dimensions: Sequence[str]) -> DataFrame:
    """Share of each value of each dimension among the rows of a group such as a day."""
    sets = [[*by, d] for d in dimensions]
    detail = fact.groupBy(*by, *dimensions).agg(F.count(F.lit(1)).alias("_n"))
    grouped = detail.groupingSets(sets, *by, *dimensions).agg(
        F.grouping_id().alias("_set"), F.sum("_n").alias("people")
    )
    bits = {d: 1 << (len(dimensions) - 1 - i) for i, d in enumerate(dimensions)}
    everything = (1 << len(dimensions)) - 1
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for d in dimensions:
        here = F.col("_set") == F.lit(everything - bits[d])
        name = F.when(here, d).otherwise(name)
        value = F.when(here, F.col(d).cast("string")).otherwise(value)
    named = grouped.select(*by, name.alias("dimension"), value.alias("value"), "people")
    total = F.sum("people").over(Window.partitionBy(*by, "dimension"))
    return named.withColumn("share", F.col("people") / total)


def career_timeline(
    dim: DataFrame, names: DataFrame, key: str, name: str, role: str, unit: str
) -> DataFrame:
    """The history of each entity as one text, oldest version first; a missing name is empty.

    A version list is no longer than the calendar, so one text per entity is bounded.
    """
    # The texts of the timeline.
    until = F.when(F.col("is_current"), "Present").otherwise(date_text("effective_end_date"))
    entry = F.concat(
        F.lit("• "), date_text("effective_start_date"), F.lit(" to "), until,
        F.lit("\n  └ "), F.coalesce(F.col(role), F.lit("")),
        F.lit(" ("), F.coalesce(F.col(unit), F.lit("")), F.lit(")"),
    )
    lines = (
        dim.select(key, F.struct(F.col("effective_start_date").alias("s"), entry.alias("t")).alias("e"))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("e")).alias("_e"))
    )
    body = F.array_join(F.col("_e.t"), "\n\n")
    head = F.concat(F.lit("Career History for "), F.coalesce(F.col(name), F.lit("")), F.lit(":\n\n"))
    return lines.join(names.select(key, name), key, "left").select(
        key, F.concat(head, body).alias("history")
    )


def profile_card(
    dim: DataFrame,
    static_dim: DataFrame,
    key: str,
    email: str,
    phone: str,
    mode: str,
    street: str,
    city: str,
) -> DataFrame:
    """Contact card from the current version; a missing value leaves its place empty."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    current = (
        dim.filter("is_current")
        .groupBy(key)
        .agg(*[F.max(c).alias(c) for c in dict.fromkeys([phone, mode, street, city])])
    )
    card = F.concat(
        F.lit("📧 Email: "), shown(email), F.lit("\n📞 Phone: "), shown(phone),
        F.lit("\n🏢 Work Mode: "), shown(mode),
        F.lit("\n🏠 Address: "), shown(street), F.lit(", "), shown(city),
    )
    return static_dim.select(key, email).join(current, key, "left").select(key, card.alias("profile"))
