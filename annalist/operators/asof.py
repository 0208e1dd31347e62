"""Point-in-time questions and the joins of the star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.operators.skew import HOT_ROWS, NULL_PARTS, hot_keys, salted_join


def _day(value: Column | str) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def as_of_day(dim: DataFrame, day: Column | str) -> DataFrame:
    """Every entity as it was on ``day``: the one version whose interval holds it."""
    return dim.filter(
        (F.col("effective_start_date") <= _day(day)) & (F.col("effective_end_date") >= _day(day))
    )


def between_dates(fact: DataFrame, date: str, first: Column | str, last: Column | str) -> DataFrame:
    return fact.filter(F.col(date).between(_day(first), _day(last)))


def as_of_versions(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    date: str,
    dim_key: str,
    columns: Sequence[str],
    how: str = "left",
    one_row_per_day: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach to each fact row ``columns`` of the version of ``fact_key`` valid on its date.

    Facts and versions of a key are laid in one order by day and the last version is carried
    forward: one shuffle and one sort, and work in proportion to the rows, however many days and
    versions a key has.  The intervals of a key must not overlap, which the gate checks.

    When the facts hold at most one row per key and day (``one_row_per_day``), a key cannot be hot.
    Otherwise hot keys are split and their versions copied to each part; facts without a key are
    spread, too.
    """
    if how not in {"left", "inner"}:
        raise ValueError(f"as-of lookups are left or inner, not {how}")
    version = F.struct(
        F.col("effective_end_date").alias("_to"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    versions = dim.dropna(subset=[dim_key, "effective_start_date"]).select(
        F.col(dim_key).alias("_k"), F.col("effective_start_date").alias("_d"), version.alias("_v")
    )
    part = F.when(F.col(fact_key).isNull(), F.pmod(F.xxhash64(*facts.columns), F.lit(NULL_PARTS))).otherwise(0)
    rows = facts.select(
        F.col(fact_key).alias("_k"), F.col(date).alias("_d"), F.struct(*facts.columns).alias("_f"),
        part.cast("int").alias("_part"),
    )
    versions = versions.withColumn("_part", F.lit(0))
    if not one_row_per_day:
        listed = hot_keys(facts.select(F.col(fact_key).alias("_k")), ["_k"], hot_rows).dropna()
        if not listed.isEmpty():
            salt = F.pmod(F.xxhash64("_f"), F.col("_parts")).cast("int")
            rows = rows.join(listed, "_k", "left").withColumn("_part", F.coalesce(salt, "_part")).drop("_parts")
            copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
            versions = versions.join(listed, "_k", "left").withColumn("_part", copies).drop("_parts")
    # A version comes before the facts of the day it starts on.
    both = rows.unionByName(versions, allowMissingColumns=True).withColumn("_o", F.col("_f").isNotNull())
    order = Window.partitionBy("_k", "_part").orderBy("_d", "_o")
    carried = F.last("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("_v", carried).where("_o")
    valid = F.col("_d") <= F.col("_v._to")
    if how == "inner":
        found = found.where(valid)
    values = [F.when(valid, F.col(f"_v._c{i}")).alias(c) for i, c in enumerate(columns)]
    return found.select(*[F.col("_f")[c].alias(c) for c in facts.columns], *values)


def manager_versions(
    edges: DataFrame,
    dim: DataFrame,
    manager: str,
    date: str,
    dim_key: str,
    columns: Sequence[str],
    prefix: str = "manager_",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Reporting edges with the manager's own version of that day; edges are never lost."""
    renamed = dim.select(
        dim_key,
        "effective_start_date",
        "effective_end_date",
        *[F.col(c).alias(prefix + c) for c in columns],
    )
    return as_of_versions(
        edges, renamed, manager, date, dim_key, [prefix + c for c in columns], hot_rows=hot_rows
    )


def orphan_managers(edges: DataFrame, key: str, manager: str, date: str) -> DataFrame:
    """(day, manager) pairs named as manager without a row of their own that day."""
    named = edges.filter(F.col(manager).isNotNull()).select(date, manager).distinct()
    present = edges.select(F.col(date), F.col(key).alias(manager))
    return named.join(present, [date, manager], "left_anti")


def with_dimension(fact: DataFrame, static_dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Star join: attributes of the one-row-per-entity dimension flow to a daily fact.

    A fact without a dimension row stays, with NULL attributes.  No broadcast is forced, since the dimension grows with the number of entities; Spark
    broadcasts it when its measured size allows.
    """
    return fact.join(static_dim.select(key, *columns), key, "left").select(*fact.columns, *columns)


def rows_of_selected(fact: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    return fact.join(selected.select(key), key, "left_semi")


def search_by_name(dim: DataFrame, name_column: str, text: str) -> DataFrame:
    return dim.filter(F.contains(F.lower(F.col(name_column)), F.lit(text.lower())))


def wide_extract(
    daily: DataFrame,
    base: DataFrame,
    key: str,
    identity: Sequence[str],
    state: Sequence[str],
    one_row_per_day: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """State rows with the identity columns of the entity beside them, NULL where it is unknown.

    Hot entities are split unless the state is known to hold one row per entity and day.
    """
    left, right = daily.select(*state), base.select(key, *identity)
    if one_row_per_day:
        joined = left.join(right, key, "left")
    else:
        joined = salted_join(left, right, [key], "left", hot_rows=hot_rows)
    return joined.select(*state, *identity)
