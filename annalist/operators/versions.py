"""Change detection and Type-2 versions.

All functions expect one row per entity and day (see ``conform.one_row_per_day``), so a window
over one entity holds at most as many rows as the calendar has days, however large the feed.

The tracked columns travel as one struct, so the shuffle carries them once and a single
``lag`` gives the whole previous state.  Texts and hashes are built behind the shuffle and
only for rows that are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.functions.fingerprint import fingerprint, joined_text
from annalist.operators.conform import require_day
from annalist.operators.keys import dense_keys
from annalist.spec import EntitySpec, open_end


def _fields(state: str, spec: EntitySpec) -> list[Column]:
    return [F.col(state)[c] for c in spec.tracked]


def _states(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    require_day(rows, spec)
    return rows.select(
        F.col(spec.key),
        F.col(spec.date).alias("_day"),
        F.col(spec.date).alias("_seen"),
        F.struct(*spec.tracked).alias("_now"),
    )


def _by_day(spec: EntitySpec):
    return Window.partitionBy(spec.key).orderBy("_day")


def _differs() -> Column:
    """Any tracked column is distinct from the previous state; true for a first row."""
    return ~F.col("_now").eqNullSafe(F.col("_was"))


def _is_new(spec: EntitySpec) -> Column:
    if spec.null_safe:
        return _differs()
    now = joined_text(_fields("_now", spec), spec.separator, spec.missing)
    was = joined_text(_fields("_was", spec), spec.separator, spec.missing)
    return F.col("_was").isNull() | (now != was)


def _digest(columns: Sequence[Column], spec: EntitySpec) -> Column:
    return fingerprint(columns, spec.separator, spec.null_safe, spec.missing)


def with_fingerprint(rows: DataFrame, spec: EntitySpec, name: str = "tracked_hash") -> DataFrame:
    cols = [F.col(c) for c in spec.tracked]
    return rows.withColumn(name, _digest(cols, spec))


def change_events(snapshot: DataFrame, spec: EntitySpec, with_initial_flag: bool = False) -> DataFrame:
    """One row per entity-day on which a tracked column changed, as ``prev_x, x`` pairs.

    The first day of an entity is an event with every ``prev_x`` NULL.
    """
    rows = _states(snapshot, spec).withColumn("_was", F.lag("_now").over(_by_day(spec)))
    pairs = [
        pair
        for c in spec.tracked
        for pair in (F.col("_was")[c].alias(f"prev_{c}"), F.col("_now")[c].alias(c))
    ]
    digest = _digest(_fields("_now", spec), spec)
    extra = [F.col("_was").isNull().alias("is_initial")] if with_initial_flag else []
    return rows.filter(_is_new(spec)).select(
        spec.key, F.col("_day").alias("event_date"), *pairs, digest.alias("tracked_hash"), *extra
    )


def change_log(
    snapshot: DataFrame, spec: EntitySpec, attributes: Sequence[str] | None = None
) -> DataFrame:
    """One row per changed attribute with its old and new value as text; first days excluded.

    Attributes are compared one by one with NULL as a value, so nothing hides behind the
    joined text.  The expansion happens on the changed rows only.
    """
    rows = _states(snapshot, spec).withColumn("_was", F.lag("_now").over(_by_day(spec)))
    changed = rows.filter(F.col("_was").isNotNull() & _differs())
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("attribute_name"),
                F.col("_was")[c].cast("string").alias("previous_value"),
                F.col("_now")[c].cast("string").alias("new_value"),
            )
            for c in (attributes or spec.tracked)
        ]
    )
    moved = F.filter(entries, lambda e: ~e["previous_value"].eqNullSafe(e["new_value"]))
    return (
        changed.select(spec.key, F.col("_day").alias("event_date"), F.explode(moved).alias("e"))
        .select(
            spec.key,
            "event_date",
            F.concat(F.col("e.attribute_name"), F.lit("_changed")).alias("event_type"),
            "e.attribute_name",
            "e.previous_value",
            "e.new_value",
        )
    )


def versions_from_states(states: DataFrame, spec: EntitySpec, with_last_seen: bool = False) -> DataFrame:
    """Closed date intervals from rows ``(key, _day, _seen, _now)`` and, optionally, ``_hash``.

    ``_hash`` is given when a row stands for a finished version, whose shown values need not
    reproduce its fingerprint; rows are then compared by it.

    One shuffle, one sort, two windows.  Days run backwards, so that what follows a row in
    time lies in a running frame behind it.  Only rows at which something moved are kept
    after the first window.  Under the joined-text test a version may contain rows that
    differ without changing the text (NULL moved between neighbours).  Such a version shows,
    for each column, its first non-NULL value; the rows that can contribute one are exactly
    the kept rows.
    """
    w = Window.partitionBy(spec.key).orderBy(F.col("_day").desc())
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = w.rowsBetween(Window.unboundedPreceding, -1)

    # A stored fingerprint may differ although the shown values are equal.
    stored = "_hash" in states.columns and not spec.null_safe
    before = {"_was": F.lead("_now").over(w)}
    if with_last_seen:
        before["_seen_before"] = F.lead("_seen").over(w)
        before["_seen_last"] = F.first("_seen").over(so_far)
    if stored:
        before["_hash_was"] = F.lead("_hash").over(w)
    rows = states.withColumns(before)

    # Rows that equal their predecessor column by column go first, so that texts are only
    # built for the rest.
    if stored:
        hash_moved = ~F.col("_hash").eqNullSafe(F.col("_hash_was"))
        rows = rows.filter(_differs() | hash_moved).withColumn("_new", hash_moved)
    else:
        new = F.lit(True) if spec.null_safe else _is_new(spec)
        rows = rows.filter(_differs()).withColumn("_new", new)

    after = {"_next": F.last(F.when(F.col("_new"), F.col("_day")), True).over(later)}
    if with_last_seen:
        after["_next_seen"] = F.last(F.when(F.col("_new"), F.col("_seen_before")), True).over(later)
    values = {c: F.col("_now")[c] for c in spec.tracked}
    if not spec.null_safe:
        # The earliest later value of each column, with its day: it counts only when that day
        # still belongs to the version.
        for i, (c, value) in enumerate(values.items()):
            dated = F.when(value.isNotNull(), F.struct(F.col("_day").alias("d"), value.alias("v")))
            after[f"_v{i}"] = F.last(dated, True).over(so_far)
            inside = F.col("_next").isNull() | (F.col(f"_v{i}.d") < F.col("_next"))
            values[c] = F.when(inside, F.col(f"_v{i}.v"))
    rows = rows.withColumns(after)

    digest = _digest(_fields("_now", spec), spec)
    columns = [
        F.col(spec.key),
        F.col("_day").alias("effective_start_date"),
        F.coalesce(F.date_sub("_next", 1), open_end()).alias("effective_end_date"),
        F.col("_next").isNull().alias("is_current"),
        (F.col("_hash") if stored else digest).alias("hash_diff"),
        *[v.alias(c) for c, v in values.items()],
    ]
    if with_last_seen:
        seen_to = F.when(F.col("_next").isNull(), F.col("_seen_last")).otherwise(F.col("_next_seen"))
        columns.append(seen_to.alias("last_seen_date"))
    return rows.filter("_new").select(*columns)


def build_versions(
    snapshot: DataFrame, spec: EntitySpec, with_last_seen: bool = False, by_range: bool = False
) -> DataFrame:
    """Type-2 history: a version starts on the first day and whenever the tracked state moves.

    A version ends the day before the next one starts, so missing days are bridged, and the
    last version of every entity stays open.  ``with_last_seen`` adds the last day on which
    each version was actually delivered.  ``by_range`` brings entities together by ranges of
    their key instead of by its hash, for which ``keyed_versions`` has use.
    """
    states = _states(snapshot, spec)
    if by_range:
        states = states.repartitionByRange(spec.key)
    return versions_from_states(states, spec, with_last_seen)


def keyed_versions(
    snapshot: DataFrame, spec: EntitySpec, sk: str, with_last_seen: bool = False
) -> DataFrame:
    """``build_versions`` with a dense surrogate key by entity and start.

    The entities are brought together by ranges of their key, so versions come out of the
    windows in key order and numbering them takes no shuffle of its own.
    """
    built = build_versions(snapshot, spec, with_last_seen, by_range=True)
    return dense_keys(built, [spec.key, "effective_start_date"], sk, ranged=True)


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def expand_days(dim: DataFrame, spec: EntitySpec, last_day: Column) -> DataFrame:
    """Every version as one row per day, up to ``last_day``; the inverse of ``build_versions``."""
    until = F.least(F.col("effective_end_date"), last_day)
    return dim.filter(F.col("effective_start_date") <= until).select(
        spec.key,
        F.explode(F.sequence("effective_start_date", until)).alias(spec.date),
        *spec.tracked,
    )


def close_absent(dim: DataFrame, latest: Column) -> DataFrame:
    """Close open versions of entities that the feed no longer delivers.

    ``dim`` needs ``last_seen_date``; an open version not seen on ``latest`` ends on the last
    day it was seen.
    """
    gone = F.col("is_current") & (F.col("last_seen_date") < latest)
    return dim.withColumns(
        {
            "effective_end_date": F.when(gone, F.col("last_seen_date")).otherwise(
                F.col("effective_end_date")
            ),
            "is_current": F.col("is_current") & ~gone,
        }
    )
