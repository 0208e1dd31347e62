"""Surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.sources.scratch import materialize

# monotonically_increasing_id puts the partition number above this many bits.
_ROW_BITS = 33


def _sorted_as(values) -> list[tuple]:
    """Values in Spark's ascending order, in which NULL comes first."""
    return [(v is not None, v) for v in values]


def dense_keys(
    df: DataFrame, order: Sequence[str], name: str, ranged: bool = False
) -> DataFrame:
    """Add 1..N in the order of ``order``, which must identify a row.

    The rows are range-partitioned and sorted, each gets its position inside its partition,
    and the result is written once so that both the count per partition and the final rows
    come from the same partitioning.  The driver sees one line per partition, nothing else.
    The key is a long because N may exceed 2^31.

    ``ranged`` says that ``df`` is already range-partitioned by a prefix of ``order``, which
    saves the shuffle.  This is verified on the written rows; if partitions overlap after
    all, they are partitioned again.
    """
    spark = df.sparkSession
    placed = (df if ranged else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "keys")
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(*order)).alias("low"),
        F.max(F.struct(*order)).alias("high"),
    )
    sizes = sorted(sizes.collect(), key=lambda r: r["_part"])
    if ranged and any(_sorted_as(a["high"]) >= _sorted_as(b["low"]) for a, b in zip(sizes, sizes[1:])):
        return dense_keys(placed.drop("_at"), order, name)
    starts = accumulate((r["n"] for r in sizes), initial=0)
    offsets = spark.createDataFrame(
        [(r["_part"], s) for r, s in zip(sizes, starts)], "_part long, _offset long"
    )
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row + 1)
        .select(name, *df.columns)
    )


def hashed_keys(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """A key that never shifts when history grows.

    64 bits: among n keys expect about n^2 / 2^65 collisions, so check uniqueness above some
    hundred million rows.
    """
    return df.select(F.xxhash64(*columns).alias(name), *df.columns)
