"""Sharding by extendible hashing, in DataFrame operations only.

A document's id is hashed to 60 bits. Documents whose hashes begin with the same bits share a
bucket; a bucket above the byte limit is split on its next bit, and on no others, until every
bucket fits. The buckets are the shards, a shard is named by its bits, and the directory maps each
prefix of the deepest bits looked at to its shard.

Bytes are summed per prefix before anything else, so the tree is built from at most
``2**depth`` sums however many documents share an id. Rounds of ``STEP`` bits treat only what
still does not fit. Documents that repeat one id cannot be told apart by its hash: once the 60 bits
are used up, their number inside the input partition and the hash of their text go on as 60 further
bits. A document that alone exceeds the limit is a shard of its own, named by its bits and marked
``oversize``; it splits no bucket.

Null or empty texts have 0 bytes. All null ids are one id. An empty table has no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.sources.scratch import materialize

#: Bytes of text in a shard.
LIMIT = 1 << 20
BITS = 60
STEP = 8


def bits_of(key: Column) -> Column:
    """60 bits of a key's MD5 as a text of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(key), 1, 15), 16, 2), BITS, "0")


def _settle(rows: DataFrame, limit: int, low: int, high: int) -> tuple[DataFrame, DataFrame]:
    """Split on the bits from ``low`` to ``high``: (directory, prefixes that still do not fit).

    ``rows`` has bits and bytes; all rows that share their first ``low`` bits with another one
    belong to a bucket that has to be split.
    """
    cells = rows.groupBy(F.substring("bits", 1, high).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")
    )
    nodes = (
        cells.select("cell", "bytes", "docs", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
        .groupBy(F.expr("substring(cell, 1, depth)").alias("shard"), "depth")
        .agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    )
    fit = nodes.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
    above = fit.select(F.col("shard").alias("above"))
    leaves = fit.join(above, F.expr(f"depth > {low} AND above = substring(shard, 1, depth - 1)"), "left_anti")
    # A leaf answers for every prefix of ``high`` bits below it that some document has.
    directory = (
        cells.select("cell", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
        .withColumn("shard", F.expr("substring(cell, 1, depth)"))
        .join(leaves, ["shard", "depth"])
    )
    open_cells = nodes.where((F.col("depth") == high) & (F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1))
    return directory, open_cells.select(F.col("shard").alias("cell"))


def numbered(docs: DataFrame, name: str = "row_number") -> DataFrame:
    """``docs`` written once with a number per row, by which `write_shards` tells rows of equal or null ids apart."""
    docs = docs.select(*[F.col(c) for c in docs.columns if c != name])
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "shard-numbered")


def assign_shards(docs: DataFrame, limit: int = LIMIT, row: str | None = None) -> DataFrame:
    """doc_id, bytes, shard, depth, shard_bytes, shard_docs, oversize: one row per document.

    ``row`` names a column of `numbered` documents, which is carried along as row_number."""
    carried = [F.col(row).alias("row_number")] if row else []
    kept = ["row_number"] if row else []
    rows = docs.select(
        *carried,
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
        bits_of(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("bits"),
        F.xxhash64("text").alias("content"),
    )
    rows = materialize(rows, "shard-rows")
    large = rows.where(F.col("bytes") > limit).select(
        *kept,
        "doc_id",
        "bytes",
        F.col("bits").alias("shard"),
        F.lit(BITS).alias("depth"),
        F.col("bytes").alias("shard_bytes"),
        F.lit(1).cast("long").alias("shard_docs"),
        F.lit(True).alias("oversize"),
    )
    left = rows.where(F.col("bytes") <= limit)
    total = left.agg(F.sum("bytes")).first()[0] or 0
    expected = max(0, total // limit).bit_length()
    out, low, high, used = large, 0, min(BITS, expected + STEP), BITS
    while True:
        directory, unsettled = _settle(left, limit, low, high)
        cell = F.substring("bits", 1, high)
        directory = materialize(directory, "shard-directory")
        placed = left.withColumn("cell", cell).join(directory, "cell")
        out = out.unionByName(
            placed.select(*kept, "doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_docs", F.lit(False).alias("oversize"))
        )
        unsettled = materialize(unsettled, "shard-open")
        if unsettled.isEmpty():
            return out
        left = materialize(left.withColumn("cell", cell).join(unsettled, "cell", "left_semi").drop("cell"), "shard-left")
        if high == used:
            # Equal ids: number them where they were read and go on with the bits of that number.
            number = F.concat_ws("/", F.col("content").cast("string"), F.monotonically_increasing_id().cast("string"))
            left = materialize(left.withColumn("bits", F.concat("bits", bits_of(number))), "shard-ids")
            used += BITS
        low, high = high + 1, min(used, high + STEP)


def write_shards(docs: DataFrame, shards: DataFrame, path: str, row: str = "doc_id") -> None:
    """Write ``docs`` as one folder per shard under ``path``.

    ``row`` tells rows apart and must be there and distinct, which is checked: the ids, or where ids are
    null or repeated the column of `numbered`, with ``assign_shards(docs, limit, row)``.

    Each shard is one task's file, and none exceeds the limit but an oversize document. A table that fits
    one shard stands in the folder that Spark names for the empty text.
    """
    number = "doc_id" if row == "doc_id" else "row_number"
    placed = shards.select(F.col(number).alias("_row"), "shard")
    twice = placed.groupBy("_row").agg(F.count(F.lit(1)).alias("n")).where("_row IS NULL OR n > 1")
    if not twice.isEmpty():
        raise ValueError(f"{row} is null or repeated; number the rows and assign shards by the number")
    left = docs.select(F.col(row).alias("_row"), *[F.col(c) for c in docs.columns if c != "shard" and (c != row or row == "doc_id")])
    left.join(placed, "_row").drop("_row").repartition("shard").write.partitionBy("shard").parquet(path)


def sharded(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return assign_shards(docs)


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
    lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), {BITS}, '0') AS bits
  FROM documents
), nodes AS (
  SELECT depth, substr(bits, 1, depth) AS shard, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM (SELECT * FROM sized WHERE bytes <= {LIMIT}), (SELECT unnest(generate_series(0, 40)) AS depth)
  GROUP BY ALL
), leaves AS (
  SELECT s.doc_id, s.bytes, min(n.depth) AS depth
  FROM sized s JOIN nodes n ON n.shard = substr(s.bits, 1, n.depth)
  WHERE s.bytes <= {LIMIT} AND (n.shard_bytes <= {LIMIT} OR n.shard_docs = 1)
  GROUP BY ALL
)
SELECT l.doc_id, l.bytes, n.shard, n.depth::INT AS depth, n.shard_bytes, n.shard_docs, false AS oversize
FROM leaves l JOIN sized s USING (doc_id) JOIN nodes n ON n.depth = l.depth AND n.shard = substr(s.bits, 1, l.depth)
UNION ALL
SELECT doc_id, bytes, bits, {BITS}, bytes, 1, true FROM sized WHERE bytes > {LIMIT}
"""
