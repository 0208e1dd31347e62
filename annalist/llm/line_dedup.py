"""Line dedup with a sharded minimal perfect hash.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least
``MIN_CHARS`` code points that stand in at least ``MIN_DOCS`` documents lose their lines, but for
those of the largest doc_id that holds them.

Keys are hashed to 128 bits and counted once per document. The hashes of repeated keys are split
into shards by their first 64 bits; each shard is built, by one task, into a minimal perfect hash
with arrays of fingerprints (the other 64 bits), counts and last holders. Keys that share their first
64 bits but not the others stand at the end of the arrays and are looked up by all 128 bits, and a
document's lines are dropped by all 128 bits. Documents send the hashes
of their lines, not the lines, to the shard's arrays and probe them there; a fingerprint that
differs says that the line is not repeated. Shards are cut so that about ``PROBES`` probes come to
each; where a frequent line makes more, the shard's arrays are given to several tasks and the probes
are dealt by document. What is dropped goes back to the documents by id.

An empty table gives an empty one. Columns of any name are carried along. A line that stands several
times in one document counts once; of documents equal in id the ties keep their lines together.
A null text has one empty line and stays null. Null ids are one id, smaller than all others. Rows
that repeat an id count as documents of their own and lose or keep a line alike. Texts are handled
whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.minimal_hash import MinimalHash, build
from annalist.sources.scratch import materialize

MIN_CHARS = 20
MIN_DOCS = 3
PROBES = 50_000
_SPACE = b" \t\n\x0b\x0c\r"


def key_of(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()  # bytes.lower() changes A-Z only


def long_enough(key: bytes) -> bool:
    n = len(key)
    if n < MIN_CHARS or n >= 4 * MIN_CHARS or key.isascii():
        return n >= MIN_CHARS
    return sum(b & 0xC0 != 0x80 for b in key) >= MIN_CHARS


def digest_of(key: bytes) -> bytes:
    """128 bits; `hash_of` has them as numbers."""
    return xxhash.xxh3_128_digest(key)


def hash_of(key: bytes) -> tuple[int, int]:
    """Two signed 64-bit halves."""
    return struct.unpack(">qq", digest_of(key))


def _line_hashes(docs: DataFrame) -> DataFrame:
    """doc_id, high, low for each distinct countable key of each document."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, *hash_of(key))
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for key in {key_of(x) for x in (text or b"").split(b"\n")}
                if long_enough(key)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["doc_id", "high", "low"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(hashed, "doc_id long, high long, low long")


ARRAYS = "shard long, sizes binary, bits binary, fingerprints binary, counts binary, holders binary, unheld binary, clashing binary"


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    again = rows["high"].duplicated().to_numpy()
    keys = rows["high"].to_numpy(np.int64).view(np.uint64)
    sizes, packed = build(keys[~again])
    order = np.argsort(MinimalHash(sizes, packed)(keys[~again]))
    # Keys whose first half is another key's, too, come last, with that half beside them.
    rows = pd.concat([rows[~again].iloc[order], rows[again]])
    clashing = rows["high"].to_numpy(np.int64)[len(order) :]
    unheld = rows["holder"].isna().to_numpy()
    holders = rows["holder"].fillna(0).to_numpy(np.int64)
    parts = [sizes, packed, rows["low"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), holders, unheld, clashing]
    names = ["shard", "sizes", "bits", "fingerprints", "counts", "holders", "unheld", "clashing"]
    return pd.DataFrame([[key[0], *(x.tobytes() for x in parts)]], columns=names)


def _probe(probes: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
    """The probes whose line is dropped: doc_id and the hash as bytes."""
    nothing = pd.DataFrame({"doc_id": pd.Series([], dtype="Int64"), "hash": pd.Series([], dtype="object")})
    if not len(probes) or not len(arrays):
        return nothing
    shard = arrays.iloc[0]
    look = MinimalHash(np.frombuffer(shard["sizes"], np.int64), np.frombuffer(shard["bits"], np.uint8))
    high = probes["high"].to_numpy(np.int64)
    number = look(high.view(np.uint64))
    found = number >= 0
    number = np.where(found, number, 0)
    low = probes["low"].to_numpy(np.int64)
    fingerprints = np.frombuffer(shard["fingerprints"], np.int64)
    found &= fingerprints[number] == low
    clashing = np.frombuffer(shard["clashing"], np.int64)
    for at, first in enumerate(clashing.tolist(), len(fingerprints) - len(clashing)):
        same = (high == first) & (low == fingerprints[at])
        number[same], found[same] = at, True
    found &= np.frombuffer(shard["counts"], np.int64)[number] >= MIN_DOCS
    unheld = np.frombuffer(shard["unheld"], bool)[number]
    holder = np.frombuffer(shard["holders"], np.int64)[number]
    absent = probes["doc_id"].isna().to_numpy()
    doc_id = probes["doc_id"].fillna(0).to_numpy(np.int64)
    keeps = np.where(unheld, absent, ~absent & (doc_id == holder))
    lost = np.flatnonzero(found & ~keeps)
    raw = np.stack([high[lost], low[lost]], axis=1).astype(">i8").tobytes()
    out = probes[["doc_id"]].iloc[lost].astype({"doc_id": "Int64"})
    out["hash"] = [raw[at : at + 16] for at in range(0, len(raw), 16)]
    return out


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, drop: the hashes of the lines that each document loses."""
    lines = materialize(_line_hashes(docs), "line-hashes")
    counted = lines.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("holder"))
    repeated = counted.where(F.col("n") >= MIN_DOCS)
    shards = -(-lines.count() // PROBES) or 1
    shard = F.pmod(F.shiftrightunsigned("high", 7), F.lit(shards).cast("long")).alias("shard")
    arrays = materialize(repeated.select("*", shard).groupBy("shard").applyInPandas(_build_shard, ARRAYS), "line-arrays")
    probes = lines.select("*", shard)
    parts = probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * PROBES)).alias("parts"))
    # Only crowded shards are dealt to several tasks, so this table is small.
    crowded = parts.where("parts > 1")
    probes = probes.join(crowded, "shard", "left").withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1)).cast("long")).cast("int")
    )
    spread = arrays.join(crowded, "shard", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)).cast("int") - 1))
    )
    hits = (
        probes.select("shard", "part", "doc_id", "high", "low").groupBy("shard", "part")
        .cogroup(spread.drop("parts").groupBy("shard", "part"))
        .applyInPandas(_probe, "doc_id long, hash binary")
    )
    return hits.groupBy("doc_id").agg(F.collect_list("hash").alias("drop"))


def cleaned(text: bytes | None, drop: list[bytes] | None) -> tuple[int, int, bytes]:
    """(lines, dropped lines, text of the other lines)."""
    lines = (text or b"").split(b"\n")
    if not drop:
        return len(lines), 0, text or b""
    gone = set(drop)
    kept = [x for x in lines if not (long_enough(key := key_of(x)) and digest_of(key) in gone)]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _with_drops(docs: DataFrame, *carried: Column) -> DataFrame:
    """text as bytes and drop beside ``carried``, which no column of ``docs`` can clash with."""
    rows = docs.select(F.col("doc_id").cast("long").alias("at"), F.col("text").cast("binary").alias("text"), *carried)
    drops = dropped_lines(docs).withColumnRenamed("doc_id", "dropped_from")
    return rows.join(drops, rows["at"].eqNullSafe(drops["dropped_from"]), "left").select("text", "drop", *[c for c in rows.columns if c not in ("at", "text")])


def line_counts(docs: DataFrame) -> DataFrame:
    """The registered query: doc_id, n_lines, n_dropped, kept_sha256."""

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [cleaned(t, d) for t, d in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([hashlib.sha256(x[2]).hexdigest() for x in out], pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return _with_drops(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(done, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of text; n_chars, where there is one, follows."""
    columns, schema = docs.columns, docs.schema

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else cleaned(t, d)[2] for t, d in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist(), strict=True)]
            rest = batch.column("rest")
            arrays = [pa.array(texts, pa.binary()).cast(pa.string()) if c == "text" else rest.field(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    rest = F.struct(*[F.col(c) for c in columns if c != "text"]).alias("rest")
    out = _with_drops(docs, rest).mapInArrow(done, schema)
    return out.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType)) if "n_chars" in columns else out


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos, len(l) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= {MIN_CHARS}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines,
  count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM (SELECT y.*, r.k IS NOT NULL AND y.doc_id <> r.holder AS gone FROM keyed y LEFT JOIN repeated r USING (k))
GROUP BY doc_id
"""
