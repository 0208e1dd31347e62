"""Equi-joins that survive a key holding a large share of one side."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.sources.scratch import materialize

# A key with more rows than this is split into parts of about so many, however large the table is.
HOT_ROWS = 1_000_000
NULL_PARTS = 1024


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, each with ``_parts``, the number of parts to split it into.

    One pass over the key columns, pre-aggregated in the map tasks. The list stays a table: it has
    less than one row for ``hot_rows`` rows of ``df``.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts")
    return materialize(counts.where(F.col("_n") > hot_rows).select(*keys, parts), "hot-keys")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    residual: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join on ``keys`` (same names on both sides), splitting hot keys of the left side.

    Rows of a hot key are spread over several salts by a hash of their content (repeatable, so
    a lost task recomputes the same rows) and the few matching rows of the right side are
    copied to each salt.  Equal rows share a part, so many equal rows of a key should be reduced
    before.  NULL keys match nothing and are spread as well.  The right side should have few rows
    per key.  Only join types that keep left rows are supported.  ``residual`` may use the non-key
    columns of both sides, whose names must not collide.

    The left keys are counted when the join is built; without a hot key, which is the usual
    case, this is a plain join.  Whether the list of hot keys is broadcast is left to Spark.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"cannot split the left side of a {how} join")
    keys = list(keys)
    rhs = right.dropna(subset=keys).withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True) if residual is None else residual
    for k in keys:
        on = (F.col(k) == F.col(f"_r_{k}")) & on

    listed = hot_keys(left, keys, hot_rows)
    lhs = left
    if not listed.isEmpty():
        no_key = F.lit(False)
        for k in keys:
            no_key = no_key | F.col(k).isNull()
        # NULL keys join nothing, so they may go anywhere: their salts need no copies on the right.
        parts = F.when(no_key, F.lit(NULL_PARTS)).otherwise(F.coalesce("_parts", F.lit(1)))
        lhs = (
            left.join(listed, keys, "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*left.columns), parts).cast("int"))
            .select(*left.columns, "_salt")
        )
        rhs = rhs.join(
            listed.withColumnsRenamed({k: f"_r_{k}" for k in keys}), [f"_r_{k}" for k in keys], "left"
        )
        copies = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
        rhs = rhs.withColumn("_r_salt", F.explode(copies)).drop("_parts")
        on = on & (F.col("_salt") == F.col("_r_salt"))
    extra = [] if how in {"left_semi", "left_anti"} else [c for c in right.columns if c not in keys]
    return lhs.join(rhs, on, how).select(*left.columns, *extra)
