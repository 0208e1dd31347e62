"""Importance resampling of documents towards a target distribution.

Documents and target texts are described by hashed runs of 1 to ``longest`` words: a run's bucket is
the CRC-32 of its UTF-8 bytes modulo ``buckets``. Each bucket has a gain, the logarithm of how much
more often the target uses it (`gains`); a document's weight is the sum of the gains of its runs,
taken from an array in one pass. Gumbel noise from a hash of the id makes the highest scores a sample
without replacement in proportion to the exponential of the weight.

The draw never sorts all documents. Scores are written once; the cut is found by bisection: each job
counts exactly, for ``SECTIONS`` thresholds at once, how many rows stand above, first over the score,
then, where rows tie at the cut, over doc_id, over n_features and over the place of the row in the
written table (`cutoff`). Only drawn rows are shuffled: they are dealt by ranges of the same order and
sorted inside; one count per range makes positions ranks. All other rows stay where they are.

Texts are read twice, where they lie. The driver holds two arrays of ``buckets`` numbers, the
thresholds and one count per range. Counts and gains cover all documents.

A null text has no words: n_features 0, weight 0. Null ids are scored like an empty id and come after
all others of their score. Very long texts are handled alone, in memory proportional to them. Rows
with the same doc_id get the same noise, are scored and drawn each for itself; rows equal in score,
id and n_features are alike in the result, so which of them is drawn does not matter. Without
documents the result is empty; without target texts (or without words in them) all gains compare with
an even target. Only doc_id and text are read; other columns, whatever their names, are left alone by
`scores` and `ranked` and carried by `resampled`.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from annalist.llm.texts import slices, text_bytes
from annalist.sources.scratch import materialize

BUCKETS = 10_000
LONGEST = 1
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
#: Thresholds counted in one job of the bisection.
SECTIONS = 16
#: Words of up to this many bytes are hashed all at once, one byte of each at a time.
SHORT = 64
_LAST = (1 << 63) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    """The step of CRC-32 for each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_STEP = _crc_table()


def _stepped(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _STEP[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def _crcs(lower: np.ndarray, first: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Register of CRC-32 after the bytes of each word, from the register ``state`` of each."""
    order = np.argsort(-lengths, kind="stable")
    begins, state = first[order], state[order]
    short = lengths[order]
    for i in np.flatnonzero(short > SHORT).tolist():
        word = lower[begins[i] : begins[i] + short[i]].tobytes()
        state[i] = zlib.crc32(word, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    long = int(np.searchsorted(-short, -SHORT, "left"))
    for at in range(min(SHORT, int(short[long]) if long < len(short) else 0)):
        alive = int(np.searchsorted(-short, -at, "left"))
        state[long:alive] = _stepped(state[long:alive], lower[begins[long:alive] + at].astype(np.uint32))
    out = np.empty_like(state)
    out[order] = state
    return out


def features(column: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of each run of words of a column of texts, and the number of words of each row."""
    data, offsets = text_bytes(column)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(column), np.int64)
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # words end with their text
    first = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    row = np.searchsorted(offsets, first, "right") - 1
    lower, lengths = _LOWER[data], end - first
    found, rows = [], []
    state = np.full(len(first), 0xFFFFFFFF, np.uint32)
    for size in range(1, longest + 1):
        if size > 1:
            together = row[:-1] == row[1:] if size == 2 else together[:-1] & together[1:]  # noqa: F821
            state = _stepped(state[:-1], np.uint32(32))
        state = _crcs(lower, first[size - 1 :], lengths[size - 1 :], state)
        kept = slice(None) if size == 1 else together
        found.append((state[kept] ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets)
        rows.append(row[: len(first) - size + 1][kept])
        if len(first) <= size:
            break
    return np.concatenate(found), np.concatenate(rows), np.bincount(row, minlength=len(column))


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many runs of all texts fall into each bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                total += np.bincount(features(part.column("text"), longest, buckets)[0], minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's share in the target and in the corpus, each count plus one, rounded down."""
    size = len(corpus)
    all_corpus, all_target = float(corpus.sum()) + size, float(target.sum()) + size
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def noise(doc_id: str | None, seed: str = SEED) -> int:
    """1000 times a Gumbel variate made from the id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, seed: str = SEED, extra: Sequence[str] = ()
) -> DataFrame:
    """doc_id, n_features, weight, score, n_words and the columns ``extra`` of each row of ``docs`` (doc_id, text)."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    names = ["n_features", "weight", "score", "n_words"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                bucket, row, words = features(part.column("text"), longest, buckets)
                n = np.bincount(row, minlength=part.num_rows)
                # Runs of one length come in order of rows, so a stable sort brings rows together.
                sums = np.concatenate([[0], np.cumsum(gain[bucket[np.argsort(row, kind="stable")]])])
                ends = np.cumsum(n)
                weight = sums[ends] - sums[ends - n]
                score = weight + np.array([noise(i, seed) for i in part.column("_id").to_pylist()], np.int64)
                kept = [part.column(c) for c in part.schema.names[2:]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *(pa.array(x.astype(np.int64)) for x in (n, weight, score, words))], names=[*part.schema.names[2:], *names]
                )

    kept = docs.select(F.col("text"), F.col("doc_id").cast("string").alias("_id"), F.col("doc_id").cast("long").alias("doc_id"), *extra)
    schema = StructType([*kept.schema.fields[2:], *(StructField(n, LongType()) for n in names)])
    return kept.mapInArrow(scored, schema)


def cutoff(rows: DataFrame, order: Sequence[str], k: int) -> Column:
    """The condition that the first ``k`` of ``rows``, in the ascending order of these integer columns, fulfil.

    Rows equal in all columns are taken or left together. Each threshold is found by exact counts.
    """
    if k <= 0:
        return F.lit(False)
    before, equal = F.lit(False), F.lit(True)
    for name in order:
        there = rows.where(equal)
        low, high = there.agg(F.min(name), F.max(name)).first()
        while low < high:
            width = high - low
            cuts = sorted({low + width * i // SECTIONS for i in range(SECTIONS)})
            counts = there.agg(*[F.count_if(F.col(name) <= F.lit(c)).alias(f"n{i}") for i, c in enumerate(cuts)]).first()
            enough = [c for c, n in zip(cuts, counts, strict=True) if n >= k]
            short = [c for c, n in zip(cuts, counts, strict=True) if n < k]
            low, high = (short[-1] + 1 if short else low), (enough[0] if enough else high)
        value = F.lit(low)
        below, here = there.agg(F.count_if(F.col(name) < value), F.count_if(F.col(name) == value)).first()
        if below + here <= k:
            return before | (equal & (F.col(name) <= value))
        before, equal, k = before | (equal & (F.col(name) < value)), equal & (F.col(name) == value), k - below
    return before | equal


_ORDER = ("_score", "_id", "n_features", "_row")


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` written, with the columns of the order of the draw."""
    return materialize(
        rows.select("*", (-F.col("score")).alias("_score"), F.coalesce("doc_id", F.lit(_LAST)).alias("_id"), F.monotonically_increasing_id().alias("_row")),
        "importance",
    )


def _drawn(placed: DataFrame, least_words: int, percent: int) -> Column:
    """The condition of drawn rows."""
    able = F.col("n_words") >= least_words
    k = percent * placed.where(able).count() // 100
    return able & cutoff(placed.where(able), _ORDER, k)


def with_ranks(rows: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """``rows`` with 1, 2, 3... in the ascending order of ``order``, by ranges that are sorted and counted."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), place], names=[*batch.schema.names, "_part", "_place"]
            )

    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = StructType([*rows.schema.fields, StructField("_part", IntegerType()), StructField("_place", LongType())])
    placed = materialize(dealt.mapInArrow(numbered, schema), "ranges")
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    starts = accumulate((n for _, n in sizes), initial=1)
    offsets = spark.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "_part int, _offset long")
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_place")).drop("_part", "_place", "_offset")


def ranked(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows of `scores` with rank: 1 for the highest score; null where the draw leaves the row.

    Of the rows with ``least_words`` words, ``percent`` in a hundred are drawn, rounded down.
    """
    placed = _placed(scored)
    drawn = _drawn(placed, least_words, percent)
    first = with_ranks(placed.where(drawn), _ORDER)
    rest = placed.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).drop("_score", "_id", "_row")


def resampled(docs: DataFrame, target: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """The drawn rows of ``docs``, all their columns, with weight, score and rank, in no particular order.

    Columns of these names in ``docs`` are replaced.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "weight", "score", "rank")]
    carried = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in rest]).alias("row"))
    drawn = ranked(scores(carried, target, extra=["row"]), least_words, percent).where("rank IS NOT NULL")
    return drawn.select("doc_id", "row.*", "weight", "score", "rank")


def importance(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The registered query: doc_id, n_features, weight, score, rank."""
    return ranked(scores(docs.select("doc_id", "text"), target)).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = rf"""
WITH crc_steps AS (
  SELECT list(v ORDER BY i) AS step FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))
), words AS (
  SELECT 'd' AS side, doc_id, row_number() OVER () AS place, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 'b', 0, 0, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), hashed AS (
  SELECT word, xor(list_reduce([4294967295::BIGINT] || [('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::BIGINT FOR k IN range(strlen(word))],
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT word FROM words), crc_steps
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM words JOIN hashed USING (word) GROUP BY bucket
), bucket_gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counts
), weights AS (
  SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight FROM words JOIN hashed USING (word) JOIN bucket_gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id
), places AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {LEAST_WORDS}
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END::BIGINT AS rank
FROM scored s LEFT JOIN places p ON p.doc_id = s.doc_id
"""
