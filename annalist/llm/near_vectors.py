"""Near duplicates of embeddings by lattice hashing.

Vectors of one label are compared by cosine. In each of ``TABLES`` tables a random projection takes
a vector to ``BLOCKS`` times eight numbers, which are decoded to points of the E8 lattice; the points
are the cell. A vector lies in its own cell and looks into those made of the ``NEAR`` nearest points
of each block. Vectors that meet in any table are compared in double precision.

What is exact at less cost is not compared pair by pair. Equal vectors are one with a count. Vectors
of one cell within half the angle of the threshold from the cell's first vector form a group: all its
members are linked. Groups, each with its centre and radius, meet in the cells of all their
members; by the triangle inequality two groups are linked throughout, not at all, or must be looked
into. There each member is judged against the other group's centre in the same way, and only members
that even this leaves open are compared with each other, in blocks inside one task. Written are counts
per member and one edge per pair of groups, never the pairs. A crowd of nearly equal vectors thus costs
rows in proportion to its size. Angles are taken from distances, whose error is far below ``SLACK`` at
any angle; whatever lies within ``SLACK`` of the threshold is judged by the cosine of the two vectors.

A link is missed only where two vectors meet in no table (see `recall` in the tests; at a cosine of
0.93 the expected recall is above 0.99). Null labels or ids, null or zero vectors, and vectors with null or
non-finite components link with nothing; so do vectors of different lengths. An id that repeats is a
vector each time: inside, vectors are named by a hash of label, length and components, and the least
id of each is carried along as a value. Very long vectors are judged in parts of few rows. Ties do not arise: a
component is named by its least id. An empty table gives an empty result; columns other than vec_id,
label and embedding are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.components import connected_components
from annalist.llm.e8 import nearest
from annalist.operators.skew import salted_join
from annalist.sources.scratch import materialize, materialize_counting

COSINE = 0.93
TABLES = 8
BLOCKS = 2
NEAR = 4
#: Distance of projected vectors in a block for each unit of distance of the vectors themselves.
SCALE = 2**0.5
SEED = 8
#: Above the error of an angle, which is a few units in the last place.
SLACK = 1e-9
#: Members of a group that are compared at once with as many of another.
CHUNK = 512

_projections: dict[tuple[int, int], np.ndarray] = {}


def projection(dim: int, table: int) -> np.ndarray:
    """(dim, 8 * BLOCKS): orthonormal directions, scaled, the same in every process."""
    if (dim, table) not in _projections:
        wide = max(dim, 8 * BLOCKS)
        q = np.linalg.qr(np.random.default_rng((SEED, dim, table)).normal(size=(wide, wide)))[0]
        _projections[dim, table] = q[:dim, : 8 * BLOCKS] * SCALE * np.sqrt(dim / 8)
    return _projections[dim, table]


def _hash(parts: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """One signed 64-bit number for each row of integers."""
    x = seed.astype(np.uint64)
    for column in parts.T:
        x = (x ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(32)
    return x.view(np.int64)


def cells(vectors: np.ndarray, table: int, near: int, seed: np.ndarray) -> np.ndarray:
    """(n, near ** BLOCKS) cells; the first is the vector's own."""
    x = vectors @ projection(vectors.shape[1], table)
    points = [nearest(x[:, 8 * b : 8 * b + 8], near) for b in range(BLOCKS)]
    out = []
    for i in range(near**BLOCKS):
        picks, rest = [], i
        for block in points:
            picks.append(block[:, rest % near])
            rest //= near
        out.append(_hash(np.concatenate(picks, axis=1), seed + np.uint64(table)))
    return np.stack(out, axis=1)


def _label_seed(labels: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in labels], np.uint64)


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        yield batch.filter(pa.array(dims == dim))


def _normal(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, v (unit vector as bytes), key; v and key are null where nothing links."""

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vec_id, label, x in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "embedding")), strict=True):
                v = np.array([np.nan if e is None else e for e in x], np.float64) if x and label is not None and vec_id is not None else None
                if v is not None and np.isfinite(v).all() and (top := np.abs(v).max()) > 0:
                    v /= top  # no overflow in the square
                    unit = (v / np.sqrt(v @ v) + 0.0).tobytes()
                    out.append((vec_id, label, len(x), unit, xxhash.xxh3_128_hexdigest(unit)))
                else:
                    out.append((vec_id, label, 0, None, None))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["vec_id", "label", "dim", "v", "key"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return rows.mapInArrow(normal, "vec_id long, label string, dim int, v binary, key string")


def _first_cells(reps: DataFrame, table: int) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_dim(batch):
                cell = cells(_vectors(part.column("v")), table, 1, _label_seed(part.column("label").to_pylist()))[:, 0]
                yield part.append_column("cell", pa.array(cell))

    return reps.mapInArrow(found, "rep long, label string, dim int, v binary, n long, least long, cell long")


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles between unit vectors, row by row, exact near 0 where a cosine says nothing."""
    half = np.sqrt(((a - b) ** 2).sum(1)) / 2
    return 2 * np.arcsin(np.minimum(half, 1.0))


def _grouped(reps: DataFrame, reach: float, tables: int) -> DataFrame:
    """rep, label, dim, v, n, least, group, angle (to the group's centre).

    A vector too far from the centre of its cell, as where two crowds share a cell, is tried again with
    the others left over, in the cells of the next table; what no table groups stays alone.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_dim(batch):
                rep, centre = (part.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "centre"))
                angle = np.where(rep == centre, 0.0, _angles(_vectors(part.column("v")), _vectors(part.column("c"))))
                near = angle <= reach
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("rep", "label", "dim", "v", "n", "least")), pa.array(np.where(near, centre, rep)), pa.array(np.where(near, angle, 0.0)), pa.array(near)],
                    names=["rep", "label", "dim", "v", "n", "least", "group", "angle", "near"],
                )

    done, rest = [], reps
    for table in range(tables):
        placed = materialize(_first_cells(rest, table), "vector-cells")
        centres = placed.groupBy("label", "dim", "cell").agg(F.min("rep").alias("centre"), F.min_by("v", "rep").alias("c"))
        met = salted_join(placed, centres, ["label", "dim", "cell"])
        kind = "rep long, label string, dim int, v binary, n long, least long, group long, angle double, near boolean"
        found, left = materialize_counting(met.mapInArrow(joined, kind), "vector-groups", "NOT near")
        done.append(found.where("near").drop("near"))
        rest = found.where("NOT near").select(*reps.columns)
        if not left:
            break
    if left:
        done.append(found.where("NOT near").drop("near"))
    return reduce(DataFrame.unionByName, done)


def _meetings(members: DataFrame, tables: int, near: int) -> DataFrame:
    """(a, b): groups, a < b, of which a member lies in a cell that a member of the other looks into."""

    def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_dim(batch):
                v, group = _vectors(part.column("v")), part.column("group").to_numpy(zero_copy_only=False)
                seed = _label_seed(part.column("label").to_pylist())
                for table in range(tables):
                    at = cells(v, table, near, seed)
                    rows = np.c_[at.ravel(), np.repeat(group, at.shape[1]), np.tile(np.arange(at.shape[1]) == 0, len(at))]
                    rows = np.unique(rows, axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2] == 1)], names=["cell", "group", "home"])

    seen = materialize(members.mapInArrow(looked, "cell long, group long, home boolean").distinct(), "vector-looks")
    home = seen.where("home").select("cell", F.col("group").alias("h"))
    met = seen.join(home, "cell").where(F.col("group") != F.col("h"))
    return met.select(F.least("group", "h").alias("a"), F.greatest("group", "h").alias("b")).distinct()


def _looked_into(pairs: DataFrame, members: DataFrame, groups: DataFrame, cosine: float, limit: float) -> tuple[DataFrame, DataFrame]:
    """(rep, from_members), the links of a member with members of the other groups of ``pairs``, and the
    pairs (a, b) with any link."""
    both = pairs.select(F.col("a").alias("group"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("group"), F.col("a").alias("other")))
    centres = groups.select(F.col("group").alias("other"), F.col("v").alias("c"), F.col("radius").alias("r"), F.col("n").alias("n_other"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_dim(batch):
                angle = _angles(_vectors(part.column("v")), _vectors(part.column("c")))
                r = part.column("r").to_numpy(zero_copy_only=False)
                every, none = angle + r <= limit - SLACK, angle - r > limit + SLACK
                keep = pa.array(~none)
                columns = [part.column(c) for c in ("group", "other", "rep", "n", "n_other", "dim", "v")] + [pa.array(every)]
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], names=["group", "other", "rep", "n", "n_other", "dim", "v", "every"])

    theirs = salted_join(members.select("group", "rep", "n", "dim", "v"), both.join(centres, "other"), ["group"])
    kind = "group long, other long, rep long, n long, n_other long, dim int, v binary, every boolean"
    judged = materialize(theirs.select("group", "other", "rep", "n", "n_other", "dim", "v", "c", "r").mapInArrow(placed, kind), "vector-judged")
    # Members linked with all of the other group; the others of that group have these links at least.
    sure = judged.where("every").groupBy("group", "other").agg(F.sum("n").alias("sure"))
    unsure = judged.where("NOT every")
    parts = unsure.groupBy("group", "other").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts"))
    side = F.when(F.col("group") < F.col("other"), "a").otherwise("b")
    a, b = F.least("group", "other").alias("a"), F.greatest("group", "other").alias("b")
    of = parts.join(parts.select(F.col("group").alias("other"), F.col("other").alias("group"), F.col("parts").alias("parts_other")), ["group", "other"])
    chunked = unsure.join(of, ["group", "other"]).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    chunked = chunked.withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("parts_other") - 1)))
    i = F.when(F.col("group") < F.col("other"), F.col("mine")).otherwise(F.col("theirs")).alias("i")
    j = F.when(F.col("group") < F.col("other"), F.col("theirs")).otherwise(F.col("mine")).alias("j")
    rows = chunked.select(a, b, i, j, side.alias("side"), "rep", "n", "v")

    def compared(unit: pa.Table) -> pa.Table:
        sides = [unit.filter(pc.equal(unit["side"], x)) for x in "ab"]
        if not all(len(x) for x in sides):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        x, y = (np.frombuffer(b"".join(t["v"].to_pylist()), np.float64).reshape(len(t), -1) for t in sides)
        n_x, n_y = (t["n"].to_numpy() for t in sides)
        near = _cosines(x, y) >= cosine
        links = np.concatenate([near @ n_y, near.T @ n_x])
        reps = np.concatenate([t["rep"].to_numpy() for t in sides])
        there = links > 0
        pair = [np.full(there.sum(), unit[c][0].as_py()) for c in "ab"]
        return pa.table({"a": pair[0], "b": pair[1], "rep": reps[there], "links": links[there]})

    met = materialize(rows.groupBy("a", "b", "i", "j").applyInArrow(compared, "a long, b long, rep long, links long"), "vector-links")
    counts = judged.where("every").select("rep", F.col("n_other").alias("links"))
    counts = counts.unionByName(unsure.join(sure.select(F.col("group").alias("other"), F.col("other").alias("group"), "sure"), ["group", "other"]).select("rep", F.col("sure").alias("links")))
    counts = counts.unionByName(met.select("rep", "links"))
    some = judged.where("every").select(a, b).unionByName(met.select("a", "b")).distinct()
    return counts.groupBy("rep").agg(F.sum("links").alias("from_members")), some


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of all rows of ``x`` with all of ``y``, each summed as for a single pair, whatever the block."""
    out = np.empty((len(x), len(y)))
    for k, v in enumerate(x):
        out[k] = (y * v).sum(1)
    return out


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, near: int = NEAR
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors`` (vec_id, label, embedding)."""
    limit = float(np.arccos(cosine))
    rows = materialize(_normal(vectors), "vectors")
    reps = rows.where("v IS NOT NULL").groupBy("label", "dim", "key").agg(F.min("vec_id").alias("least"), F.first("v").alias("v"), F.count(F.lit(1)).alias("n"))
    reps = reps.withColumn("rep", F.xxhash64("label", "dim", "key"))
    members = _grouped(reps.select("rep", "label", "dim", "v", "n", "least"), limit / 2 - SLACK, tables)
    groups = members.groupBy("group").agg(
        F.first("label").alias("label"),
        F.first("dim").alias("dim"),
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        F.max("angle").alias("radius"),
        F.count(F.lit(1)).alias("m"),
        F.max(F.when(F.col("rep") == F.col("group"), F.col("v"))).alias("v"),
    )
    groups = materialize(groups, "vector-centres")

    def side(name: str) -> DataFrame:
        return groups.select(*[F.col(c).alias(x) for c, x in (("group", name), ("label", f"label_{name}"), ("dim", f"dim_{name}"), ("radius", f"r_{name}"), ("m", f"m_{name}"), ("v", f"v_{name}"))])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_dim(batch):
                a, b = _vectors(part.column("v_a")), _vectors(part.column("v_b"))
                number = {c: part.column(c).to_numpy(zero_copy_only=False) for c in ("r_a", "r_b", "m_a", "m_b")}
                radius, angle, dots = number["r_a"] + number["r_b"], _angles(a, b), (a * b).sum(1)
                alone = (number["m_a"] == 1) & (number["m_b"] == 1)
                whole = np.where(alone, dots >= cosine, angle + radius <= limit - SLACK)
                never = np.where(alone, dots < cosine, angle - radius > limit + SLACK)
                keep = pa.array(~never)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep), pa.array(whole).filter(keep)], names=["a", "b", "whole"])

    met = _meetings(members, tables, near).join(side("a"), "a").join(side("b"), "b").where("label_a = label_b AND dim_a = dim_b")
    pairs = materialize(met.withColumnRenamed("dim_a", "dim").drop("dim_b", "label_a", "label_b").mapInArrow(judged, "a long, b long, whole boolean"), "vector-pairs")
    open_pairs = pairs.where("NOT whole").select("a", "b")
    partial, some = _looked_into(open_pairs, members, groups, cosine, limit)
    whole = pairs.where("whole").select("a", "b")
    edges = whole.unionByName(some)
    component = connected_components(edges)
    least = component.join(groups.select(F.col("group").alias("node"), "least"), "node").groupBy("component").agg(F.min("least").alias("component_least"))
    component = component.join(least, "component").select(F.col("node").alias("group"), "component_least")
    totals = groups.select("group", "n")
    to_group = (
        whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .join(totals.withColumnRenamed("group", "b"), "b")
        .groupBy(F.col("a").alias("group")).agg(F.sum("n").alias("from_groups"))
    )
    per_group = (
        groups.select("group", "n", "least").join(to_group, "group", "left")
        .join(component, "group", "left")
        .select("group", (F.col("n") - 1 + F.coalesce("from_groups", F.lit(0))).alias("links"), F.coalesce("component_least", "least").alias("component"))
    )
    per_rep = (
        members.select("rep", "group").join(per_group, "group").join(partial, "rep", "left")
        .select("rep", (F.col("links") + F.coalesce("from_members", F.lit(0))).alias("links"), "component")
    )
    by_key = reps.select("label", "dim", "key", "rep").join(per_rep, "rep").select("label", "dim", "key", "links", "component")
    done = rows.select("vec_id", "label", "dim", "key").join(by_key, ["label", "dim", "key"], "left")
    component_id = F.coalesce("component", "vec_id")
    return done.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        (F.col("vec_id").eqNullSafe(component_id)).alias("kept"),
    )


ORACLE = f"""
WITH vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true)
), units AS (
  SELECT vec_id, label, len(v) AS dim, v, sqrt(list_dot_product(v, v)) AS size FROM vectors WHERE list_dot_product(v, v) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.label = b.label AND a.dim = b.dim AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / a.size / b.size >= {COSINE}
), reach AS (
  WITH RECURSIVE r(node, least) AS (
    SELECT a, a FROM links UNION SELECT l.b, r.least FROM r JOIN links l ON l.a = r.node WHERE r.least < l.b
  ) SELECT node, min(least) AS component FROM r GROUP BY node
)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, e.vec_id) AS component_id,
  e.vec_id = coalesce(component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = e.vec_id LEFT JOIN reach r ON r.node = e.vec_id
"""
