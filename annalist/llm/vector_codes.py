"""Vector code compression: product codes from k-means with adaptive distance bounds, in integers.

Components become integers, ``floor(SCALE * x)``; a vector is cut into ``PARTS`` equal parts, and each
part position has a codebook of ``ENTRIES`` entries. They start as the parts of the first vectors by
id; each round assigns every part to its nearest entry (ties to the lower index) and moves each entry
to the rounded-down mean of its parts; entries without parts stay. After the rounds parts are assigned
once more.

Assignment follows Drake and Hamerly. Each part keeps, beside its entry, its ``b`` closest other
entries with lower bounds of their distances in ascending order, and one outer lower bound for all the
rest. When entries move, the upper bound grows and the lower bounds shrink by the distances moved.
The place where the upper bound stays below all further bounds says how many of the close entries can
have overtaken: none (the part is certain), the first few (only these are compared), or unknown (all
entries are compared and the list is made anew). Bounds are kept in single precision, rounded to the
safe side; whatever they leave open is decided by squared distances of integers, which are exact, so
codes never depend on the bounds. ``b`` adapts: after each round it becomes the depth that served
``SERVED`` of the parts that needed comparing, between one 32nd and one quarter of the entries.

The state lies in a table that is written once a round; no vector is shuffled. A task adds up its own
counts and sums per entry, which are then summed per (part, entry): 1,024 rows. The driver holds the
codebooks, whose size does not grow with the data, and a histogram of depths.

Vectors that are null, empty, or hold null or non-finite components are dropped. Null ids come after
all others, and vectors with the same id (or none) in order of their bytes; each is encoded for
itself. With fewer vectors than entries there are as many entries as vectors; an empty table gives an
empty result. All other vectors must have one length, divisible by the parts, and integers below 2^26
in magnitude, so that squared distances stay exact: otherwise an error says so. Long vectors make
codebooks larger in proportion. Columns other than vec_id, label and embedding are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.operators.skew import salted_join
from annalist.sources.scratch import discard, materialize, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SERVED = 0.95
#: Integers of larger magnitude are refused.
LARGEST = 1 << 26
#: Vectors handled at once.
GROUP = 4096
#: Numbers of labels up to which their sums are broadcast, 16 MB at most.
FEW_LABELS = 200_000
_LABEL_BYTES = 64


def _up(x: np.ndarray) -> np.ndarray:
    """Single precision, never below ``x``."""
    y = x.astype(np.float32)
    return np.where(y < x, np.nextafter(y, np.float32(np.inf)), y)


def _down(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


#: Above the error of a square root and a few additions in double precision.
_SAFE = 1e-12


def _over(squared: np.ndarray) -> np.ndarray:
    return _up(np.sqrt(squared.astype(np.float64)) * (1 + _SAFE))


def _under(squared: np.ndarray) -> np.ndarray:
    return _down(np.sqrt(squared.astype(np.float64)) * (1 - _SAFE))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points from all entries, as integers."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if points.shape[1] * 4 * most * most < 1 << 53:  # every sum below is an integer that a double holds
        x, c = points.astype(np.float64), entries.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(points), len(entries)), np.int64)
    for k, entry in enumerate(entries):
        out[:, k] = ((points - entry) ** 2).sum(1)
    return out


class Bounds:
    """Codes and bounds of the parts at one position: code, upper, near (n, b), lower (n, b), outer."""

    def __init__(self, code: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray, outer: np.ndarray) -> None:
        self.code, self.upper, self.near, self.lower, self.outer = code, upper, near, lower, outer

    @classmethod
    def fresh(cls, points: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        """From all distances."""
        d = squared(points, entries)
        order = np.argsort(d, axis=1, kind="stable")[:, : b + 2]  # stable: ties to the lower index
        sorted_d = np.take_along_axis(d, order, 1)
        short = max(0, b + 2 - len(entries))  # fewer entries than the list has places
        order = np.pad(order, ((0, 0), (0, short)))
        bounds = np.pad(_under(sorted_d), ((0, 0), (0, short)), constant_values=np.inf)
        return cls(order[:, 0].astype(np.uint16), _over(sorted_d[:, 0]), order[:, 1 : b + 1].astype(np.uint16), bounds[:, 1 : b + 1], bounds[:, b + 1])

    def resized(self, b: int) -> Bounds:
        """With lists of ``b`` entries: bounds given up go into the outer one, new places hold it."""
        old = self.near.shape[1]
        if b < old:
            return Bounds(self.code, self.upper, self.near[:, :b], self.lower[:, :b], np.minimum(self.outer, self.lower[:, b:].min(1)))
        near = np.concatenate([self.near, np.repeat(self.code[:, None], b - old, 1)], axis=1)
        lower = np.concatenate([self.lower, np.repeat(self.outer[:, None], b - old, 1)], axis=1)
        return Bounds(self.code, self.upper, near, lower, self.outer)

    def moved(self, moves: np.ndarray) -> Bounds:
        """After entries moved by at most ``moves``; lower bounds in ascending order again."""
        moves = moves.astype(np.float64)
        upper = _up(self.upper + moves[self.code])
        lower = np.concatenate([self.lower - moves[self.near], (self.outer - moves.max())[:, None]], axis=1)
        lower = _down(np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1])
        return Bounds(self.code, upper, self.near, lower[:, :-1], lower[:, -1])

    def depths(self) -> np.ndarray:
        """How many of the close entries may be as near as the part's own; one more than ``b``: any entry may."""
        return (self.lower <= self.upper[:, None]).sum(1) + (self.outer <= self.upper)


def reassigned(points: np.ndarray, entries: np.ndarray, state: Bounds, b: int) -> tuple[Bounds, np.ndarray]:
    """Exact codes of the parts with new bounds, and the depth that each part needed."""
    state = state.resized(b)
    open_ = np.flatnonzero(state.depths() > 0)
    if len(open_):
        own = ((points[open_] - entries[state.code[open_]]) ** 2).sum(1)
        state.upper[open_] = _over(own)
    depth = state.depths()
    some = np.flatnonzero((depth > 0) & (depth <= b))
    if len(some):
        _compare_some(points, entries, state, some, depth[some])
    every = np.flatnonzero(depth > b)
    if len(every):
        new = Bounds.fresh(points[every], entries, b)
        for name in ("code", "upper", "near", "lower", "outer"):
            getattr(state, name)[every] = getattr(new, name)
    return state, depth


def _compare_some(points: np.ndarray, entries: np.ndarray, state: Bounds, rows: np.ndarray, depth: np.ndarray) -> None:
    """Compare each of ``rows`` with its own entry and the first ``depth`` close ones; write code and bounds."""
    deep = int(depth.max())
    ids = np.concatenate([state.code[rows, None], state.near[rows, :deep]], axis=1).astype(np.int64)
    there = np.arange(deep + 1) <= depth[:, None]
    r, z = np.nonzero(there)
    d = np.full(ids.shape, np.iinfo(np.int64).max)
    d[r, z] = ((points[rows[r]] - entries[ids[r, z]]) ** 2).sum(1)
    # Ascending by distance, then index; places beyond the depth stay behind, in their order.
    rank = np.lexsort((np.where(there, ids, len(entries) + np.arange(deep + 1)), d), axis=1)
    ids, d = np.take_along_axis(ids, rank, 1), np.take_along_axis(d, rank, 1)
    state.code[rows] = ids[:, 0]
    state.upper[rows] = _over(d[:, 0])
    known = np.arange(1, deep + 1) <= depth[:, None]
    lower = np.where(known, _under(np.where(known, d[:, 1:], 0)), state.lower[rows, :deep])
    state.near[rows, :deep] = np.where(known, ids[:, 1:], state.near[rows, :deep])
    state.lower[rows, :deep] = lower


_STATE = "vec_id long, label string, v binary, state binary, error long"
_SUMS = "part int, entry int, n long, sums array<long>"


def _packed(states: list[Bounds]) -> list[bytes]:
    """One byte string for each vector: of each part the code, the close entries and the bounds."""
    rows = [
        np.concatenate([s.code[:, None].view(np.uint8).reshape(len(s.code), -1), np.ascontiguousarray(s.near).view(np.uint8).reshape(len(s.code), -1),
                        np.ascontiguousarray(np.concatenate([s.upper[:, None], s.lower, s.outer[:, None]], axis=1).astype(np.float32)).view(np.uint8).reshape(len(s.code), -1)], axis=1)
        for s in states
    ]
    joined = np.ascontiguousarray(np.concatenate(rows, axis=1))
    return [x.tobytes() for x in joined]


def _unpacked(column: pa.Array, parts: int) -> list[Bounds]:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), parts, -1)
    b = (raw.shape[2] - 2 - 8) // 6
    out = []
    for p in range(parts):
        ids = np.ascontiguousarray(raw[:, p, : 2 + 2 * b]).view(np.uint16)
        bounds = np.ascontiguousarray(raw[:, p, 2 + 2 * b :]).view(np.float32)
        out.append(Bounds(ids[:, 0].copy(), bounds[:, 0].copy(), ids[:, 1:].copy(), bounds[:, 1:-1].copy(), bounds[:, -1].copy()))
    return out


def _ints(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), -1).astype(np.int64)


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v (components as 32-bit integers) of the vectors that are kept."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes | None] = []
            for x in batch.column("embedding").to_pylist():
                v = np.array([np.nan if e is None else e for e in x], np.float64) if x else None
                if v is None or not np.isfinite(v).all():
                    out.append(None)
                    continue
                v = np.floor(scale * v)
                if np.abs(v).max() >= LARGEST:
                    raise ValueError(f"a component beyond {LARGEST // scale} in magnitude")
                out.append(v.astype(np.int32).tobytes())
            column = pa.array(out, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], column], names=["vec_id", "label", "v"]).filter(pc.is_valid(column))

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return rows.mapInArrow(kept, "vec_id long, label string, v binary")


def _first_codebooks(rows: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    taken = rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    return np.split(np.array([np.frombuffer(r["v"], np.int32) for r in taken], np.int64), parts, axis=1)


def _round(table: DataFrame, books: list[np.ndarray], old: list[np.ndarray] | None, b: int, last: bool) -> DataFrame:
    """State rows after an assignment, and one row of sums for each entry (part, entry, n, sums) of each task."""
    parts, width = len(books), books[0].shape[1]
    moves = None if old is None else [np.nextafter(_over(((x - y) ** 2).sum(1)).astype(np.float64), np.inf) for x, y in zip(books, old, strict=True)]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, len(books[0])), np.int64)
        sums = np.zeros((parts, len(books[0]), width), np.int64)
        depths = np.zeros((parts, len(books[0]) + 2), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                points = np.split(_ints(part.column("v")), parts, axis=1)
                states = None if moves is None else _unpacked(part.column("state"), parts)
                new, error = [], np.zeros(part.num_rows, np.int64)
                for p, (x, book) in enumerate(zip(points, books, strict=True)):
                    if states is None:
                        state = Bounds.fresh(x, book, b)
                    else:
                        state, depth = reassigned(x, book, states[p].moved(moves[p]), b)
                        depths[p] += np.bincount(depth, minlength=depths.shape[1])
                    np.add.at(sums[p], state.code, x)
                    counts[p] += np.bincount(state.code, minlength=len(book))
                    error += ((x - book[state.code]) ** 2).sum(1) if last else 0
                    new.append(state)
                codes = [s.code.astype(np.uint8).tobytes() for s in new] if last else None
                state = [bytes(c) for c in zip(*codes, strict=True)] if last else _packed(new)
                yield _batch(part.column("vec_id"), part.column("label"), part.column("v"), pa.array(state, pa.binary()), pa.array(error))
        if not last:
            yield _sums(counts, sums, depths)

    names = ["vec_id", "label", "v"] + (["state"] if moves is not None else [])
    return table.select(*names).mapInArrow(assigned, f"{_STATE}, {_SUMS}")


_NAMES = ["vec_id", "label", "v", "state", "error", "part", "entry", "n", "sums"]
_KINDS = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]


def _batch(*columns: pa.Array) -> pa.RecordBatch:
    n = len(columns[0])
    rest = [pa.nulls(n, k) for k in _KINDS[len(columns) :]]
    return pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, _KINDS, strict=False)] + rest, names=_NAMES)


def _sums(counts: np.ndarray, sums: np.ndarray, depths: np.ndarray) -> pa.RecordBatch:
    """Rows of sums; depths stand behind the entries, at entry = -1 - depth."""
    part, entry = np.nonzero(counts)
    at, depth = np.nonzero(depths)
    lists = [x.tolist() for x in sums[part, entry]] + [None] * len(at)
    n = len(lists)
    columns = [pa.nulls(n, k) for k in _KINDS[:5]]
    columns += [
        pa.array(np.concatenate([part, at]).astype(np.int32)), pa.array(np.concatenate([entry, -1 - depth]).astype(np.int32)),
        pa.array(np.concatenate([counts[part, entry], depths[at, depth]])), pa.array(lists, pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _means(state: DataFrame, books: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """New codebooks, and how many parts needed which depth."""
    width = books[0].shape[1]
    totals = state.where("part IS NOT NULL").groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    new, depths = [x.copy() for x in books], np.zeros(len(books[0]) + 2, np.int64)
    for row in totals.collect():
        if row["entry"] < 0:
            depths[-1 - row["entry"]] += row["n"]
        else:
            new[row["part"]][row["entry"]] = [row[2 + i + 1] // row["n"] for i in range(width)]
    return new, depths


def adapted(b: int, depths: np.ndarray, entries: int) -> int:
    """The number of close entries to keep: the depth that served ``SERVED`` of the parts compared in part."""
    least, most = max(1, entries // 32), max(1, entries // 4)
    served = depths[1 : b + 1]
    if not served.sum():
        return least if not depths[b + 1 :].sum() else min(most, 2 * b)
    if depths[b + 1 :].sum() > served.sum():  # lists too short for most
        return min(most, 2 * b)
    return int(np.clip(1 + np.searchsorted(np.cumsum(served), SERVED * served.sum()), least, most))


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, v, code bytes as state, error) of all rows of `integers`, and the codebooks (entries, width) by part."""
    lengths = rows.select(F.length("v").alias("n")).agg(F.min("n").alias("a"), F.max("n").alias("b")).first()
    if lengths["a"] is None:
        return rows.select("*", F.lit(None).cast("binary").alias("state"), F.lit(None).cast("long").alias("error")), []
    if lengths["a"] != lengths["b"] or lengths["a"] // 4 % parts:
        raise ValueError(f"vectors of {lengths['a'] // 4} to {lengths['b'] // 4} components cannot be cut into {parts} equal parts of one width")
    books = _first_codebooks(rows, parts, entries)
    b = max(1, len(books[0]) // 8)
    table, path, old = rows, None, None
    for _ in range(rounds):
        before = path
        state, path = written(_round(table, books, old, b, False), "vector-codes")
        if before:
            discard(rows.sparkSession, before)  # the new table holds all that is needed from here on
        old = books
        books, depths = _means(state, books)
        if depths.sum():
            b = adapted(b, depths, len(books[0]))
        table = state.where("part IS NULL")
    coded = materialize(_round(table, books, old, b, True).select("vec_id", "label", "v", "state", "error"), "vector-codes")
    if path:
        discard(rows.sparkSession, path)
    return coded, books


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, codes (one byte for each part), error) of the kept vectors, and the codebooks.

    A vector is restored, up to its error, by putting the entries of its codes side by side and
    dividing by ``SCALE`` (`restored`).
    """
    if entries > 256:
        raise ValueError("a code is one byte")
    rows = materialize(integers(vectors), "vector-integers")
    coded, books = fit(rows, parts, entries, rounds)
    return coded.select("vec_id", "label", F.col("state").alias("codes"), "error"), books


def restored(codes: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """``codes`` (vec_id, label, codes, error) with embedding, the vector that the codes stand for."""

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            vectors = np.concatenate([book[raw[:, p]] for p, book in enumerate(books)], axis=1) / scale if len(raw) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(vectors), pa.list_(pa.float64()))], names=[*batch.schema.names, "embedding"])

    rows = codes.select("vec_id", "label", "codes", "error")
    return rows.mapInArrow(looked_up, "vec_id long, label string, codes binary, error long, embedding array<double>")


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error: the errors of all rows of the label; null labels are one.

    The sums of few labels are sent to every task; more are joined, hot labels in several parts.
    """
    named = codes.withColumn("_label", F.concat(F.when(F.col("label").isNull(), "0").otherwise("1"), F.coalesce("label", F.lit(""))))
    sums = materialize(named.groupBy("_label").agg(F.sum("error").alias("label_error")), "label-errors")
    n, wide = sums.agg(F.count(F.lit(1)), F.max(F.length("_label"))).first()
    if n * max(wide or 0, 1) <= FEW_LABELS * _LABEL_BYTES:
        return named.join(F.broadcast(sums), "_label").drop("_label")
    return salted_join(named, sums, ["_label"], "left").drop("_label")


def vector_codes(vectors: DataFrame) -> DataFrame:
    """The registered query: vec_id, code, error, label_error, codebooks_sha256."""
    codes, books = compressed(vectors)
    flat = ",".join(str(x) for book in books for entry in book.tolist() for x in entry)
    digest = hashlib.sha256(flat.encode()).hexdigest()
    return with_label_errors(codes).select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    """Every round written out; distances of all parts from all entries."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS place, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true)
), part_points AS MATERIALIZED (
  SELECT vec_id, place, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) r(p)
), book_0 AS MATERIALIZED (SELECT p, place - 1 AS entry, x AS c FROM part_points WHERE place <= {ENTRIES})"""]  # fmt: skip
    for r in range(ROUNDS + 1):
        steps.append(f"""
, near_{r} AS MATERIALIZED (
  SELECT vec_id, a.p, min((d, entry)) AS best FROM (
    SELECT vec_id, a.p, entry, list_sum([(y[1] - y[2]) * (y[1] - y[2]) FOR y IN list_zip(x, c)])::BIGINT AS d FROM part_points a JOIN book_{r} b ON a.p = b.p
  ) a GROUP BY vec_id, a.p
)""")
        if r < ROUNDS:
            steps.append(f"""
, mean_{r} AS (
  SELECT p, entry, list(m ORDER BY i) AS c FROM (
    SELECT a.p, best[2] AS entry, i, floor(sum(x[i]) / count(*)::DOUBLE)::BIGINT AS m
    FROM part_points a JOIN near_{r} n ON a.vec_id = n.vec_id AND a.p = n.p, range(1, 65) w(i) WHERE i <= len(x) GROUP BY a.p, best[2], i
  ) GROUP BY p, entry
), book_{r + 1} AS MATERIALIZED (SELECT b.p, b.entry, coalesce(m.c, b.c) AS c FROM book_{r} b LEFT JOIN mean_{r} m ON m.p = b.p AND m.entry = b.entry)""")
    steps.append(f"""
, coded AS (
  SELECT vec_id, string_agg(lower(lpad(to_hex(best[2]), 2, '0')), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM near_{ROUNDS} GROUP BY vec_id
)
SELECT c.vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) FROM book_{ROUNDS}) AS codebooks_sha256
FROM coded c JOIN kept k ON k.vec_id = c.vec_id
""")
    return "".join(steps)


ORACLE = _oracle()
