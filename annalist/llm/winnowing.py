"""Document fingerprints by winnowing, in DataFrame operations only.

Words are hashed, every run of ``GRAM`` words gets a polynomial (Karp-Rabin) hash, and of each
window of ``WINDOW`` consecutive hashes the least is chosen, the rightmost on ties. A choice keeps
its position, so two texts that share ``GRAM + WINDOW - 1`` words in a row are certain to share a
choice inside them, and it says where.

Hash and position are one number, ``hash << 32 | (2**32 - 1 - position)``: its minimum is the least
hash and on ties the largest position. All steps are array expressions on one row; nothing is
exploded or shuffled for a fingerprint.

A text of fewer words than ``GRAM`` is one run, fewer hashes than ``WINDOW`` are one window, and a
null text is an empty one: it has no choices, and the likeness of two texts without choices is 1.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.tables import WORD

GRAM = 5
WINDOW = 8
#: Multiplier and modulus of the rolling hash.
BASE = 1000003
PRIME = 2147483647
LAST = 4294967295
#: Documents that are put in order by one task.
PART = 4096


def _horner(items: list[str]) -> str:
    out = f"{items[0]} % {PRIME}"
    for item in items[1:]:
        out = f"(({out}) * {BASE}L + {item}) % {PRIME}"
    return out


def with_choices(df: DataFrame, text: str, out: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add ``out``: the chosen numbers of the column ``text`` in order of position."""
    x, v = f"{out}_x", f"{out}_v"
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    df = df.withColumn(
        x, F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"))
    )
    runs = f"transform(sequence(0, size({x}) - {gram}), i -> {_horner([f'{x}[i + {j}]' for j in range(gram)])})"
    whole = f"array(aggregate({x}, 0L, (a, b) -> (a * {BASE}L + b) % {PRIME}))"
    hashes = f"CASE WHEN size({x}) >= {gram} THEN {runs} WHEN size({x}) > 0 THEN {whole} ELSE array() END"
    df = df.withColumn(v, F.expr(f"transform({hashes}, (h, i) -> shiftleft(h, 32) | ({LAST}L - i))"))
    least = ", ".join(f"{v}[i + {j}]" for j in range(window))
    choices = (
        f"CASE WHEN size({v}) >= {window} THEN array_distinct(transform(sequence(0, size({v}) - {window}), i -> least({least})))"
        f" WHEN size({v}) > 0 THEN array(array_min({v})) ELSE {v} END"
    )
    return df.withColumn(out, F.expr(choices)).drop(x, v)


def fingerprint(choices: str) -> Column:
    """Choices as a text: hexadecimal hash, ``@``, number of the run's first word; comma-joined."""
    one = f"concat(lower(hex(shiftright(c, 32))), '@', {LAST}L - (c & {LAST}L))"
    return F.expr(f"array_join(transform({choices}, c -> {one}), ',')")


def hashes(choices: str) -> Column:
    return F.expr(f"array_distinct(transform({choices}, c -> shiftright(c, 32)))")


def likeness(a: str, b: str) -> Column:
    """Shared distinct hashes over all distinct hashes; 1 when there are none."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def shared_runs(a: str, b: str) -> Column:
    """Where two columns of choices agree: array of (hash, at, other)."""
    same = f"filter({b}, d -> shiftright(d, 32) = shiftright(c, 32))"
    pair = (
        f"named_struct('hash', shiftright(c, 32), 'at', {LAST}L - (c & {LAST}L), 'other', {LAST}L - (d & {LAST}L))"
    )
    return F.expr(f"flatten(transform({a}, c -> transform({same}, d -> {pair})))")


def in_ranges(df: DataFrame, part_rows: int = PART) -> DataFrame:
    """Add ``part``, the range of ids a row belongs to; higher ids have higher parts.

    Only the bounds are gathered, 8 bytes for each ``part_rows`` documents.
    """
    value = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    ids = df.select(value.alias("id"))
    parts = -(-ids.count() // part_rows)
    cuts = ids.approxQuantile("id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    splits = [float("-inf"), *sorted({c for c in cuts if c > float("-inf")}), float("inf")]
    if len(splits) == 2:
        return df.withColumn("part", F.lit(0))
    ranges = Bucketizer(splits=splits, inputCol="id", outputCol="part", handleInvalid="keep")
    return ranges.transform(df.withColumn("id", value)).drop("id").withColumn("part", F.col("part").cast("int"))


def with_next(
    docs: DataFrame, derive: Callable[[DataFrame], DataFrame], carry: list[str], part_rows: int = PART
) -> DataFrame:
    """``derive(docs)`` with ``next_<c>`` for each column ``c`` of ``carry``: its value in the row that
    follows in descending doc_id. Null ids come last, rows of one id are ordered by the hash of their
    text, and the first row follows the last.

    Each range of ids is one window, so a text is shuffled once; the first row of each range is fetched
    for the last row of the one before. Ids are expected to be unique: rows of one id share a range.
    """
    ranged = in_ranges(docs, part_rows)
    down = Window.orderBy(F.desc("part"))
    tops = ranged.groupBy("part").agg(F.max("doc_id").alias("top"))
    around = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = tops.select("part", F.coalesce(F.lead(F.struct("top")).over(down), F.first(F.struct("top")).over(around))["top"].alias("top"))
    there = edges.select(F.col("top").alias("doc_id")).distinct()
    at_edges = docs.join(there, docs["doc_id"].eqNullSafe(there["doc_id"]), "left_semi")
    row = F.struct(*carry).alias("row")
    at_edges = (
        derive(at_edges).select("doc_id", row, F.xxhash64("text").alias("same"))
        .groupBy("doc_id").agg(F.min_by("row", "same").alias("edge"))
    )
    edges = edges.join(at_edges, edges["top"].eqNullSafe(at_edges["doc_id"])).select("part", "edge")
    order = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), "same")
    rows = derive(ranged.repartition("part")).withColumn("same", F.xxhash64("text"))
    rows = rows.withColumn("follows", F.lead(row).over(order)).join(edges, "part")
    for c in carry:
        following = F.when(F.col("follows").isNotNull(), F.col("follows")[c]).otherwise(F.col("edge")[c])
        rows = rows.withColumn(f"next_{c}", following)
    return rows.drop("part", "same", "follows", "edge")


def fingerprints(docs: DataFrame) -> DataFrame:
    """The registered query: every document's fingerprint, that of its edited text, and likenesses.

    The edited text is the document with its last ``n_chars // 2`` code points replaced by the first
    as many, or all, of the next document's.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def derive(df: DataFrame) -> DataFrame:
        return with_choices(df, "text", "own").withColumn("marks", hashes("own"))

    rows = with_next(docs, derive, ["text", "marks"])
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.expr("cast(n_chars div 2 as int)")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    rows = rows.withColumn("edited", edited).drop("text", "next_text")
    rows = with_choices(rows, "edited", "new").withColumn("new_marks", hashes("new"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"),
        fingerprint("new").alias("edited_fingerprint"),
        likeness("marks", "new_marks").alias("near_edited"),
        likeness("marks", "next_marks").alias("near_next"),
    )


ORACLE = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), pairs AS (
  SELECT *, coalesce(lead(doc_id) OVER down, first_value(doc_id) OVER down) AS next_id,
    CASE WHEN lead(doc_id) OVER down IS NULL THEN first_value(text) OVER down ELSE lead(text) OVER down END AS next_text
  FROM docs WINDOW down AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), texts AS (
  SELECT doc_id, 0 AS kind, text FROM pairs
  UNION ALL
  SELECT doc_id, 1, left(text, n - n // 2) || left(next_text, n // 2) FROM pairs
), tokens AS (
  SELECT doc_id, kind, len(w) AS m, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT doc_id, kind, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts)
), hashed AS (
  SELECT doc_id, kind, m, pos, ('0x' || substr(md5(word), 1, 8))::BIGINT AS x FROM tokens
), runs AS (
  SELECT doc_id, kind, m, pos, x % {PRIME} AS x0,
    lead(x, 1) OVER o AS x1, lead(x, 2) OVER o AS x2, lead(x, 3) OVER o AS x3, lead(x, 4) OVER o AS x4
  FROM hashed WINDOW o AS (PARTITION BY doc_id, kind ORDER BY pos)
), folded AS (
  SELECT doc_id, kind, m, pos,
    list_reduce([x0] || list_filter([x1, x2, x3, x4], lambda y: y IS NOT NULL), lambda a, b: (a * {BASE} + b) % {PRIME}) AS h
  FROM runs WHERE pos = 0 OR pos <= m - {GRAM}
), choices AS (
  SELECT doc_id, kind, pos, greatest(1, m - {GRAM - 1}) AS g, min(h * 4294967296 + {LAST} - pos) OVER (
    PARTITION BY doc_id, kind ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS v
  FROM folded
), chosen AS (
  SELECT DISTINCT doc_id, kind, v, v // 4294967296 AS h, {LAST} - v % 4294967296 AS pos
  FROM choices WHERE pos = 0 OR pos <= g - {WINDOW}
), prints AS (
  SELECT doc_id, kind, string_agg(lower(to_hex(h)) || '@' || pos, ',' ORDER BY pos) AS print, list_distinct(list(h)) AS marks
  FROM chosen GROUP BY ALL
)
SELECT p.doc_id, p.n AS n_chars, sha256(e.text) AS edited_sha256,
  coalesce(a.print, '') AS fingerprint, coalesce(b.print, '') AS edited_fingerprint,
  coalesce(len(list_intersect(a.marks, b.marks)), 0) / greatest(1, len(list_distinct(coalesce(a.marks, []) || coalesce(b.marks, [])))) * 1.0
    + CASE WHEN a.marks IS NULL AND b.marks IS NULL THEN 1.0 ELSE 0.0 END AS near_edited,
  coalesce(len(list_intersect(a.marks, c.marks)), 0) / greatest(1, len(list_distinct(coalesce(a.marks, []) || coalesce(c.marks, [])))) * 1.0
    + CASE WHEN a.marks IS NULL AND c.marks IS NULL THEN 1.0 ELSE 0.0 END AS near_next
FROM pairs p
JOIN texts e ON e.doc_id = p.doc_id AND e.kind = 1
LEFT JOIN prints a ON a.doc_id = p.doc_id AND a.kind = 0
LEFT JOIN prints b ON b.doc_id = p.doc_id AND b.kind = 1
LEFT JOIN prints c ON c.doc_id = p.next_id AND c.kind = 0
"""
