"""Quality scores: ridge regression on random Fourier features of document statistics.

Random cosines of the standardised statistics approximate a Gaussian kernel, so a linear fit of them
is a smooth fit of the statistics. The fit needs sums only: each partition adds up its part of the
normal equations, partitions are added up in two steps, and one small system is solved. Scores of
labelled rows that the fit has not seen then give an isotonic calibration, by pooling adjacent
violators over bins of the raw score.

Statistics are of the text alone: labels, language, source and keys are no input of a score. Null and
empty texts have statistics, and a score, as any other. Repeated rows are scored one by one. Of
several labels for one key the lowest counts; null labels are left out. Without labels of both kinds
every score is the share of good labels (one half without any).
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.storage import stored

STATISTICS = (
    "log_words", "mean_word", "log_lines", "letters", "upper", "digits", "symbols", "marks",
    "high", "distinct_words", "distinct_lines", "marked_words", "longest_word", "repeated_words",
)
FEATURES = 256
BANDWIDTH = 3.0
RIDGE = 1e-3
SEED = 7
# Raw scores are binned this finely, from -0.5 to 1.5, before calibration.
BINS = 2048
# Groups of partitions whose sums are sent to the driver.
SUM_GROUPS = 16


def _classes(*groups: bytes) -> np.ndarray:
    table = np.zeros((256, len(groups)))
    for i, group in enumerate(groups):
        table[list(group), i] = 1
    return table


_CLASSES = _classes(
    bytes(range(97, 123)) + bytes(range(65, 91)), bytes(range(65, 91)), b"0123456789",
    b"#*$%&|<>@^~_=+{}[]\\/", b"!?.,;:'\"()-", bytes(range(128, 256)),
)


def statistics(text: bytes | None) -> list[float]:
    """The statistics of a text in UTF-8, in the order of ``STATISTICS``."""
    text = text or b""
    size = max(1, len(text))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = (counts @ _CLASSES / size).tolist()
    words = text.split()
    lines = text.split(b"\n")
    n = max(1, len(words))
    pairs = set(zip(words, words[1:]))
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words)
    return [
        math.log1p(len(words)), math.log1p(len(text) / n), math.log1p(len(lines)), *shares,
        len(set(words)) / n, len(set(lines)) / len(lines), marked / n,
        math.log1p(max(map(len, words), default=0)), 1 - (len(pairs) + 1) / n if words else 0.0,
    ]


def document_statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, stats)``: one row per row of ``docs``."""

    def run(batches):
        for batch in batches:
            rows = [statistics(value) for value in batch.column(1).to_pylist()]
            stats = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["key", "stats"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, stats array<double>")


class Model(NamedTuple):
    """A fitted scorer; arrays only, of a size that does not depend on the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return _cosines((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        found = np.searchsorted(self.edges, _bins(self.raw(stats)), "right") - 1
        return self.values[found.clip(min=0)]


def _cosines(standard: np.ndarray) -> np.ndarray:
    """Random Fourier features, and a constant."""
    rng = np.random.default_rng(SEED)
    waves = rng.normal(0, 1 / BANDWIDTH, (standard.shape[1], FEATURES))
    shifts = rng.uniform(0, 2 * np.pi, FEATURES)
    waved = np.cos(standard.clip(-8, 8) @ waves + shifts) * math.sqrt(2 / FEATURES)
    return np.concatenate([waved, np.ones((len(standard), 1))], axis=1)


def _bins(raw: np.ndarray) -> np.ndarray:
    return ((raw + 0.5) * (BINS / 2)).clip(0, BINS - 1).astype(np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def _summed(rows: DataFrame, run, width: int) -> np.ndarray:
    """Add up the vectors that ``run`` makes of each partition: within groups of partitions, then
    over groups, so that no task holds more than one sum and the driver gets a single vector.
    Vectors are added in the order of their partitions, so that a repeated task gives the same."""

    def numbered(batches):
        for batch in run(batches):
            yield _numbered(batch.column(0))

    def add(batches):
        total = np.zeros(width)
        for batch in batches:
            for vector in batch.column(1):
                total += np.frombuffer(vector.as_buffer())
        yield _numbered(pa.array([total.tobytes()], pa.binary()))

    kind = "part int, v binary"
    parts = rows.mapInArrow(numbered, kind).repartition(SUM_GROUPS, "part")
    sums = parts.sortWithinPartitions("part").mapInArrow(add, kind).repartition(1)
    total = sums.sortWithinPartitions("part").mapInArrow(add, kind).first()
    return np.frombuffer(total.v).copy() if total else np.zeros(width)


def _numbered(vectors: pa.Array) -> pa.RecordBatch:
    part = pa.array([TaskContext.get().partitionId()] * len(vectors), pa.int32())
    return pa.RecordBatch.from_arrays([part, vectors], ["part", "v"])


def _vector(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])


def _normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    size = FEATURES + 1

    def run(batches):
        total = np.zeros((size + 1, size))
        for batch in batches:
            if batch.num_rows:
                z = _cosines((_matrix(batch.column(0), len(mean)) - mean) / scale)
                total[:size] += z.T @ z
                total[size] += batch.column(1).to_numpy(zero_copy_only=False) @ z
        yield _vector(total.ravel())

    return _summed(rows, run, (size + 1) * size).reshape(size + 1, size)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    width = len(STATISTICS)

    def run(batches):
        total = np.zeros(2 * width + 1)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            total += np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]])
        yield _vector(total)

    total = _summed(rows, run, 2 * width + 1)
    n = max(1.0, total[-1])
    mean = total[:width] / n
    return mean, np.sqrt(np.maximum(total[width:-1] / n - mean**2, 1e-9))


def _pooled(sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression over bins: neighbours that violate the order are pooled."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(counts):
        blocks.append([int(i), float(sums[i]), float(counts[i])])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, total, count = blocks.pop()
            blocks[-1][1] += total
            blocks[-1][2] += count
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, calibrate: Column) -> Model:
    """Fit a scorer. ``stats(key, stats)`` and ``labels(key, label)``, label 0 or 1; labelled rows
    where ``calibrate`` (over ``key``) holds fit the calibration, the rest the regression."""
    lowest = labels.filter("label IS NOT NULL AND key IS NOT NULL").groupBy("key")
    rows = stored(
        stats.join(lowest.agg(F.min("label").cast("double").alias("label")), "key")
        .withColumn("late", calibrate).select("stats", "label", "late"),
        "quality-labelled",
    )
    early = rows.filter(~F.col("late"))
    mean, scale = _moments(early)
    equations = _normal_equations(early, mean, scale)
    size = FEATURES + 1
    n = max(1.0, equations[size - 1, size - 1])
    ridge = np.eye(size) * RIDGE * n / FEATURES
    ridge[-1, -1] = 1e-9
    weights = np.linalg.solve(equations[:size] + ridge, equations[size])
    model = Model(mean, scale, weights, np.zeros(1, np.int64), np.full(1, 0.5))

    def run(batches):
        total = np.zeros((2, BINS))
        for batch in batches:
            if batch.num_rows:
                bins = _bins(model.raw(_matrix(batch.column(0), len(mean))))
                label = batch.column(1).to_numpy(zero_copy_only=False)
                total[0] += np.bincount(bins, label, BINS)
                total[1] += np.bincount(bins, minlength=BINS)
        yield _vector(total.ravel())

    # A corpus with few labels may have none to calibrate on; then all of them do.
    sums, counts = _summed(rows.filter("late"), run, 2 * BINS).reshape(2, BINS)
    if counts.sum() == 0:
        sums, counts = _summed(rows, run, 2 * BINS).reshape(2, BINS)
    edges, values = _pooled(sums, counts)
    return model._replace(edges=edges, values=values) if len(edges) else model


def scores(stats: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``(key, score, predicted)`` for every row of ``stats``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = model.score(_matrix(batch.column(1), len(model.mean)))
                good = pa.array((score >= 0.5).astype(np.int32))
                columns = [batch.column(0), pa.array(score), good]
                yield pa.RecordBatch.from_arrays(columns, ["key", "score", "predicted"])

    kind = stats.schema["key"].dataType.simpleString()
    out = stats.select("key", "stats").mapInArrow(
        run, f"key {kind}, score double, predicted int"
    )
    return out.withColumnRenamed("key", key)


def fold(key: str = "key", folds: int = 3) -> Column:
    """The fold of a row: CRC-32 of its key as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def _fitted(stats: DataFrame, labels: DataFrame, key: str) -> Model:
    used = labels.select(F.col(key).alias("key"), F.col("quality").alias("label"))
    return fit(stats, used.filter(fold() != 1), fold() == 2)


def classified(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, ``held_out``, ``score`` and ``predicted``.

    ``labels(key, quality)``. Fold 1 is held out, fold 0 fits the regression, fold 2 calibrates.
    """
    stats = stored(document_statistics(docs, key=key), "quality-statistics")
    model = _fitted(stats, labels, key)
    held_out = F.coalesce(fold(key) == 1, F.lit(False))
    return scores(stats, model, key).select(key, held_out.alias("held_out"), "score", "predicted")


def accepted(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` with a score of one half or more, by the model of ``classified``.

    Rows are scored again where they are read, so that texts are not shuffled.
    """
    stats = stored(document_statistics(docs, text, key), "quality-statistics")
    model = _fitted(stats, labels, key)
    column = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            values = batch.column(column).to_pylist()
            rows = [statistics(None if v is None else v.encode()) for v in values]
            if rows:
                yield batch.filter(pa.array(model.score(np.array(rows)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
