"""Mixing sources to target weights by systematic sampling.

All sizes together are shared among the sources by weight; a source takes at most ``most`` times
what it has, and what it cannot take goes to the others by weight. Inside a source every document
expects ``target / source size`` copies. The documents stand in order of size, then of the MD5 of
their id, then of the id; the expected copies are summed along that order, one offset per source is
added, and a document is taken once for each whole number its interval crosses. Ordering by size
spreads the sample over short and long documents, so words come close to the target and not only
documents.

A document longer than a ``LONG``-th of its source's target is too much to be taken or left by chance
at the end of that order. These long documents come first, from the longest down, each expecting what
is still to be taken over what is still there, so that each makes up for those before it; a count after which
the rest could not reach the target, or must go beyond it, is not taken where there is another. The rest,
with the words that are left for it, is sampled as above, and its words miss the target by
less than its longest document. A source has fewer than LONG * source size / target long documents, at most
LONG times the sum of all weights over its own; one task holds them as ids and sizes.

The running sum is never one sorted list: positions are counted per (source, size), per block of
4,096 id hashes in it, and per id in the block, and each count is a window over a bounded part.
Rows equal in source, size and id are one row with a count on the way.

Columns of other names are not read. Documents of one size are ties that the MD5 of the id, then the id, decides.
Nulls: a null source is a source (the last); a null id is an id; a null text has size 0. A table
without words gets targets 0 and takes nothing. Repeated rows stay separate rows of the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.tables import hex_long, words_in
from annalist.sources.scratch import materialize

WEIGHTS = (5, 2, 1)
MOST = 3
#: A document of more than this part of its source's target is long.
LONG = 50
SEED = "mix-1"


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED
) -> DataFrame:
    """One row per source: source, rank (its number), source_size, target, offset.

    ``sizes`` has source and size. Sources in order of code points, null last, weigh
    ``weights`` in turn. After one sum per source only source rows are left, and the window
    over all of them is over that small table.
    """
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1)
    ranked = ranked.withColumn("weight", weight.cast("double")).withColumn("cap", (F.col("source_size") * most).cast("double"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tightest = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    onwards = tightest.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onwards)
    filled = ranked.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    # The first source that stays below its limit sets the level of all that do.
    common = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        tightest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("free"), common * F.col("weight")).otherwise(F.col("cap"))
    offset = hex_long(F.concat(F.coalesce("source", F.lit("")), F.lit(f"#{seed}")), 8) / F.lit(4294967296.0)
    return filled.select("source", "rank", "source_size", target.alias("target"), offset.alias("offset"))


def long_copies(sizes: Sequence[int], source_size: int, target: float, offset: float, most: int = MOST) -> list[int]:
    """Copies of a source's long documents, whose sizes come from the longest down."""
    out, words, size_left = [], target, source_size
    for size in sizes:
        low = math.ceil((words - most * (size_left - size)) / size)
        high = math.floor(words / size)
        expected = words / size_left
        # Where no count lets the rest come out even, the nearest one.
        n = math.floor(expected + 0.5) if low > high else min(max(math.floor(expected + offset), low), high)
        n = min(max(n, 0), most)
        out.append(n)
        words, size_left = words - n * size, size_left - size
    return out


def _long_documents(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` (doc_id, source, size, rank, source_size, target, offset, key), all of them long, with their copies."""

    def counted(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("key", "ascending"), ("doc_id", "ascending")])
        first = {c: table.column(c)[0].as_py() for c in ("source_size", "target", "offset")}
        copies = long_copies(table.column("size").to_pylist(), **first, most=most)
        return table.append_column("copies", pa.array(copies, pa.int64()))

    schema = rows.withColumn("copies", F.lit(0).cast("long")).schema
    return rows.groupBy("rank").applyInArrow(counted, schema)


def _id_key() -> Column:
    return F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit(""))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows equal in rank, size and id once each, with their count ``m`` and their place ``start``."""
    rows = rows.groupBy("rank", "size", "doc_id").agg(F.count(F.lit(1)).alias("m")).withColumn("key", _id_key())
    rows = rows.withColumn("block", F.substring("key", 1, 3))
    by_block = rows.groupBy("rank", "size", "block").agg(F.sum("m").alias("n"))
    by_size = by_block.groupBy("rank", "size").agg(F.sum("n").alias("n"))

    def start(of: str, *within: str) -> Window:
        return Window.partitionBy(*within).orderBy(of).rowsBetween(Window.unboundedPreceding, -1)

    before_size = F.coalesce(F.sum("n").over(start("size", "rank")), F.lit(0))
    before_block = F.coalesce(F.sum("n").over(start("block", "rank", "size")), F.lit(0))
    blocks = (
        by_block.withColumn("in_size", before_block)
        .join(by_size.select("rank", "size", before_size.alias("of_size")), ["rank", "size"])
        .select("rank", "size", "block", (F.col("in_size") + F.col("of_size")).alias("of_block"))
    )
    order = Window.partitionBy("rank", "size", "block").orderBy("key", F.asc_nulls_last("doc_id"))
    in_block = F.coalesce(F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("in_block", in_block).join(blocks, ["rank", "size", "block"]).select(
        "rank", "size", "doc_id", "m", (F.col("in_block") + F.col("of_block")).alias("start")
    )


def _crossed(rate: Column, offset: Column, at: Column) -> Column:
    return F.floor(rate * at + offset)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words) of documents; the texts go no further."""
    return docs.select("doc_id", "source", words_in(F.col("text")).alias("size"))


def mix(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: one row per row of ``sizes``
    (doc_id, source, size). Reruns give the same copies."""
    sizes = materialize(sizes.select("doc_id", "source", "size"), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, most, seed), "mix-targets")
    each = sizes.withColumnRenamed("source", "of")
    rows = each.join(targets, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    is_long = F.col("size") * LONG > F.col("target")
    long = materialize(_long_documents(rows.where(is_long).withColumn("key", _id_key()), most), "mix-long")
    spent = long.groupBy("rank").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.sum("size").alias("passed"))
    size_left = F.col("source_size") - F.coalesce("passed", F.lit(0))
    rate = F.when(size_left > 0, (F.col("target") - F.coalesce("taken", F.lit(0))) / size_left).otherwise(0.0)
    left = targets.join(spent, "rank", "left").withColumn("rate", F.greatest(F.lit(0.0), F.least(F.lit(float(most)), rate)))
    short = _placed(rows.where(~is_long).select("rank", "size", "doc_id")).join(left, "rank")
    short = short.withColumn("at", F.explode(F.sequence(F.col("start") + 1, F.col("start") + F.col("m"))))
    copies = _crossed(F.col("rate"), F.col("offset"), F.col("at")) - _crossed(
        F.col("rate"), F.col("offset"), F.col("at") - 1
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "copies"]
    return short.withColumn("copies", copies).select(*columns).unionByName(long.select(*columns))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every document as often as the mix takes it; the columns stay.

    Rows equal in all columns stand together as one row until the copies are written out, so a
    group of equal rows takes as many copies as its rows do together.
    """
    columns = docs.columns
    row = F.struct(*[F.col(c) for c in columns])
    keyed = docs.select(
        row.alias("row"),
        F.xxhash64(*[F.col(c) for c in columns]).alias("same"),
        "doc_id",
        "source",
        words_in(F.col("text")).alias("size"),
    )
    # The id of the sampled rows is the document's id with the hash of its row.
    tag = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), F.col("same").cast("string"))
    keyed = keyed.withColumn("tag", tag)
    taken = (
        mix(keyed.select(F.col("tag").alias("doc_id"), "source", "size"), **options)
        .groupBy(F.col("doc_id").alias("tag"))
        .agg(F.sum("copies").alias("copies"))
        .where("copies > 0")
    )
    whole = keyed.groupBy("tag").agg(F.first("row").alias("row"))
    copied = whole.join(taken, "tag").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copied.select(*[F.col("row")[c].alias(c) for c in columns])


QUERY_COLUMNS = ("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """The registered query: what the mix takes of each document."""
    out = mix(sized(docs)).withColumn("taken", F.col("size") * F.col("copies"))
    return out.select(*QUERY_COLUMNS)


ORACLE = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rnk
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, ([5.0, 2.0, 1.0])[((rnk - 1) % 3 + 1)::INT]::DOUBLE AS weight, (source_size * {MOST})::DOUBLE AS cap
  FROM ranked
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM ranked)::DOUBLE
     - coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
     / sum(weight) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM weighed
), common AS (
  SELECT arg_min(lvl, (cap / weight, rnk)) AS lvl FROM levels WHERE lvl * weight <= cap
), targets AS (
  SELECT l.source, l.rnk, l.source_size,
    CASE WHEN l.lvl * l.weight <= l.cap THEN c.lvl * l.weight ELSE l.cap END AS target,
    ('0x' || substr(md5(coalesce(l.source, '') || '#{SEED}'), 1, 8))::BIGINT / 4294967296.0 AS shift
  FROM levels l, common c
), rows_of AS (
  SELECT s.doc_id, s.source, s.size, t.rnk, t.source_size, t.target, t.shift, s.size * {LONG} > t.target AS is_long
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), longs AS (
  SELECT *, row_number() OVER (PARTITION BY rnk ORDER BY size DESC, md5(doc_id::VARCHAR), doc_id) AS k
  FROM rows_of WHERE is_long
), walk AS (
  SELECT rnk, 0::BIGINT AS k, 0::BIGINT AS n, 0::BIGINT AS taken, 0::BIGINT AS passed FROM targets
  UNION ALL
  SELECT rnk, k, n, taken + n * size, passed + size FROM (
    SELECT *, least(greatest(CASE WHEN low > high THEN floor(words / size_left + 0.5)
      ELSE least(greatest(floor(words / size_left + shift), low), high) END, 0), {MOST})::BIGINT AS n
    FROM (
      SELECT *, ceil((words - {MOST} * (size_left - size)) / size) AS low, floor(words / size) AS high
      FROM (
        SELECT l.rnk, l.k, l.size, l.shift, w.taken, w.passed,
          l.target - w.taken AS words, l.source_size - w.passed AS size_left
        FROM walk w JOIN longs l ON l.rnk = w.rnk AND l.k = w.k + 1)))
), remaining AS (
  SELECT t.rnk, CASE WHEN t.source_size > w.passed
    THEN greatest(0.0, least({MOST}.0, (t.target - w.taken) / (t.source_size - w.passed))) ELSE 0.0 END::DOUBLE AS rate
  FROM targets t JOIN (SELECT rnk, max(taken) AS taken, max(passed) AS passed FROM walk GROUP BY rnk) w USING (rnk)
), placed AS (
  SELECT r.*, q.rate, row_number() OVER (PARTITION BY rnk ORDER BY size, md5(doc_id::VARCHAR), doc_id) AS pos
  FROM rows_of r JOIN remaining q USING (rnk) WHERE NOT is_long
), counted AS (
  SELECT doc_id, size, source_size, target, source,
    (floor(rate * pos + shift) - floor(rate * (pos - 1) + shift))::BIGINT AS copies FROM placed
  UNION ALL
  SELECT l.doc_id, l.size, l.source_size, l.target, l.source, w.n FROM longs l JOIN walk w ON w.rnk = l.rnk AND w.k = l.k
)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM counted
"""
