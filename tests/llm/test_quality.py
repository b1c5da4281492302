import zlib

import numpy as np
import pytest

from listwright.llm import quality
from listwright.llm.queries import QUERIES

from .odd import documents, odd_documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op6_quality"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 80
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(0, 1), (7, 0), (7, 1), (14, None), (None, 1), (21, 1), (999, 0)],
        "doc_id bigint, quality int",
    )
    got = quality.classified(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == docs.count()
    again = quality.classified(docs.repartition(3), labels)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, again.collect()))
    none = quality.classified(docs, labels.filter("false")).select("score").distinct()
    assert [r.score for r in none.collect()] == [0.5]
    assert quality.classified(documents(spark, []), labels).count() == 0


def test_fit_solves_the_normal_equations(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(int)
    stats = spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(x)], "key bigint, stats array<double>"
    )
    labels = spark.createDataFrame(
        [(i, int(v)) for i, v in enumerate(y)], "key bigint, label int"
    ).repartition(5)
    from pyspark.sql import functions as F

    model = quality.fit(stats, labels, F.col("key") % 4 == 0)
    early = np.arange(400) % 4 != 0
    mean, scale = x[early].mean(axis=0), x[early].std(axis=0)
    z = quality._cosines((x[early] - mean) / scale)
    ridge = np.eye(z.shape[1]) * quality.RIDGE * early.sum() / quality.FEATURES
    ridge[-1, -1] = 1e-9
    want = np.linalg.solve(z.T @ z + ridge, z.T @ y[early])
    assert np.allclose(model.weights, want, atol=1e-6)
    assert (np.diff(model.values) > 0).all()


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, len(quality.STATISTICS)))
    z = quality._cosines(x)[:, :-1]
    far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    kernel = np.exp(-far / (2 * quality.BANDWIDTH**2))
    assert np.abs(z @ z.T - kernel).mean() < 0.06


@pytest.mark.parametrize("seed", range(5))
def test_pooling(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 4, 40)
    sums = rng.binomial(counts, 0.5).astype(float)
    edges, values = quality._pooled(sums, counts)
    bins = np.flatnonzero(counts)
    got = values[np.searchsorted(edges, bins, "right") - 1]
    # The isotonic fit by its min-max form.
    want = [
        max(
            min(sums[a : b + 1].sum() / counts[a : b + 1].sum() for b in bins if b >= i)
            for a in bins
            if a <= i
        )
        for i in bins
    ]
    assert np.allclose(got, want)
