"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

A text is described by statistics of its bytes, words and lines. Standardised, they are projected
to random cosines whose products approximate a Gaussian kernel; ridge regression on them is solved
from the sums of X'X and X'y that each partition makes, so the driver sees one matrix of fixed size
however many rows are labelled. Raw scores of a part of the labelled rows that the regression has not
seen are calibrated by isotonic regression over a fixed grid of scores.

Labels are learnt from rows whose ``crc32(doc_id as text) % 5`` is not 0: remainders 1 to 3 fit the
ridge, 4 fits the calibration. No label, id, language or source enters a score. All labelled rows
are used; nothing is sampled.

Nulls: a null text is an empty one and gets a score; a null id counts as the empty text in crc32 and
has no label; null labels are not used, and an id labelled twice has the mean of its labels. Without
any labelled row every score is 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.sources.scratch import materialize

FOLDS = 5
COSINES = 256
RIDGE = 1.0
THRESHOLD = 0.3
SEED = 20
#: Raw scores are put on a grid of this width before calibration; they are cut at -1 and 2.
STEP = 1 / 2000

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".,",
    "shout": b"!?",
    "symbol": b"#$%&*+/<=>@\\^_`{}~",
    "bar": b"|",
    "quote": b"\"'()-:;[]",
    "beyond": bytes(range(128, 256)),
}
_LOOKUP = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _LOOKUP[list(_members), _i] = 1

FEATURES = (
    *_CLASSES, "log_bytes", "log_words", "entropy", "word_length", "word_spread", "longest_word", "distinct",
    "commonest", "repeats", "word_entropy", "long_words", "log_line", "distinct_lines", "pairs",
)


def statistics(text: bytes | None) -> list[float]:
    """The values of FEATURES for one text."""
    text = text or b""
    n = len(text)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = (histogram / max(1, n)) @ _LOOKUP
    p = histogram[histogram > 0] / max(1, n)
    words = text.split()
    m = len(words)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, m) if m else np.zeros(1)
    q = np.fromiter(counts.values(), np.float64, len(counts)) / max(1, m)
    repeats = sum(map(bytes.__eq__, words, words[1:])) if m > 1 else 0
    lines = text.split(b"\n")
    pairs = len(set(zip(words, words[1:], strict=False))) / (m - 1) if m > 1 else 1.0
    return [
        *shares.tolist(),
        float(np.log1p(n)),
        float(np.log1p(m)),
        float(-(p * np.log(p)).sum()),
        float(lengths.mean()),
        float(lengths.std()),
        float(np.log1p(lengths.max())),
        len(counts) / max(1, m),
        float(q.max()) if m else 0.0,
        repeats / max(1, m),
        float(-(q * np.log(q)).sum()) / max(1.0, float(np.log(max(2, m)))),
        float((lengths > 12).mean()),
        float(np.log1p(n / len(lines))),
        len(set(lines)) / len(lines),
        pairs,
    ]


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, fold, features for every document, written once."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in batch.column("text").to_pylist()]
            values = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fold"), values], names=["doc_id", "fold", "features"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold(F.col("doc_id")).cast("int").alias("fold"), F.col("text").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(described, "doc_id long, fold int, features array<double>"), "quality-features")


class Model:
    """Means and spreads of the statistics, the projection, ridge weights and calibration."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.frequency = rng.normal(0.0, np.sqrt(2 / len(mean)), (len(mean), COSINES))
        self.phase = rng.uniform(0, 2 * np.pi, COSINES)
        self.weights: np.ndarray | None = None
        self.knots = (np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def lifted(self, features: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        z = np.clip((features - self.mean) / self.spread, -6, 6)
        cosines = np.cos(z @ self.frequency + self.phase) * np.sqrt(2 / COSINES)
        return np.c_[cosines, np.ones(len(z))]

    def raw(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), 0.5)
        return np.clip(self.lifted(features) @ self.weights, -1, 2)

    def score(self, features: np.ndarray) -> np.ndarray:
        raw = self.raw(features)
        level = np.interp(raw, *self.knots)
        # Isotonic steps are flat; a thousandth of the raw score keeps the order inside a step.
        return np.clip(0.999 * level + 0.001 * (raw + 1) / 3, 0, 1)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, level) of the non-decreasing fit."""
    blocks: list[list[float]] = []
    for x, y, w in zip(at, mean, weight, strict=True):
        blocks.append([x * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    x, y, w = np.array(blocks).T
    return x / w, y / w


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _normal_equations(rows: DataFrame, model: Model) -> np.ndarray:
    """X'[X y] summed by partition and then by row of the matrix."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((COSINES + 1, COSINES + 2))
        for batch in batches:
            if batch.num_rows:
                x = model.lifted(_matrix(batch))
                total += x.T @ np.c_[x, batch.column("label").to_numpy(zero_copy_only=False)]
        yield _rows_of(dict(enumerate(total)))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, values in zip(batch.column("i").to_pylist(), batch.column("sums"), strict=True):
                row = values.values.to_numpy(zero_copy_only=False)
                total[i] = total[i] + row if i in total else row
        yield _rows_of(total)

    schema = "i int, sums array<double>"
    sums = rows.mapInArrow(of_partition, schema).repartition("i").mapInArrow(summed, schema).collect()
    out = np.zeros((COSINES + 1, COSINES + 2))
    for r in sums:
        out[r["i"]] += np.array(r["sums"])
    return out


def _rows_of(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(rows), pa.int32()), pa.array([v.tolist() for v in rows.values()], pa.list_(pa.float64()))],
        names=["i", "sums"],
    )


def fit(described: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled rows of ``described``; ``labels`` has doc_id and quality."""
    moments = described.select(F.posexplode("features").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).collect()
    mean, spread = np.zeros(len(FEATURES)), np.ones(len(FEATURES))
    for r in moments:
        mean[r["i"]], spread[r["i"]] = r["m"], r["s"]
    model = Model(mean, spread)
    by_id = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("label"))
    known = materialize(described.where("fold <> 0").join(by_id, "doc_id").select("fold", "features", "label"), "quality-known")
    sums = _normal_equations(known.where("fold < 4"), model)
    if sums[-1, -2] == 0:
        return model
    a, b = sums[:, :-1], sums[:, -1]
    penalty = np.full(COSINES + 1, RIDGE)
    penalty[-1] = 0
    model.weights = np.linalg.solve(a + np.diag(penalty) + 1e-9 * np.eye(len(a)), b)

    def on_grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = np.round(model.raw(_matrix(batch)) / STEP).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("label")], names=["cell", "label"])

    cells = known.where("fold = 4").mapInArrow(on_grid, "cell int, label double").groupBy("cell").agg(F.avg("label").alias("y"), F.count(F.lit(1)).alias("w")).orderBy("cell").collect()
    if cells:
        model.knots = isotonic(*(np.array([r[k] for r in cells], dtype=float) * s for k, s in (("cell", STEP), ("y", 1), ("w", 1))))
    return model


def score(described: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.score(_matrix(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(batch.column("fold").to_numpy(zero_copy_only=False) == 0), pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return described.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query: a score for every document."""
    described = describe(docs)
    return score(described, fit(described, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, columns unchanged.

    The text itself is scored on the way, so rows that share an id are judged each by its own text.
    """
    model = fit(describe(docs), labels)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                keep = model.score(np.array([statistics(t) for t in texts])) >= THRESHOLD
                yield batch.filter(pa.array(keep))

    return docs.mapInArrow(judged, docs.schema)
