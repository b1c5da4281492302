"""The pipeline, stage by stage, against plain versions on the smallest tables."""

import pytest

import corpus_pipeline
from listwright.llm import bpe, decontaminate, quality
from listwright.llm.queries import VOCABULARY
from listwright.storage import fresh_path

from . import test_line_dedup, test_simhash
from .odd import odd_documents, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents, and what each stage leaves of them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage")
        stage(spark, found[-1], SF).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_columns(stages):
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in quality.classified(stages[0], labels).filter("predicted = 1").collect()}
    assert sorted(texts(stages[1])) == sorted(t for t in texts(stages[0]) if t[0] in kept)
    assert 0 < len(kept) < stages[0].count()


def test_lines(stages):
    want = test_line_dedup.plain(texts(stages[1]))
    assert sorted(texts(stages[2])) == sorted((w[0], w[2]) for w in want)
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_duplicates(stages):
    near = test_simhash.plain_near(texts(stages[2]))
    firsts = {key for key, _, component in near if key == component}
    assert {t[0] for t in texts(stages[3])} == firsts
    assert stages[3].count() == len(firsts)


def test_leaks(spark, stages):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = decontaminate.contaminated(stages[3], benchmark).select("doc_id").collect()
    gone = {r.doc_id for r in found}
    assert sorted(texts(stages[4])) == sorted(t for t in texts(stages[3]) if t[0] not in gone)


def test_encoding(spark, stages):
    assert rows_of(stages[5]) == rows_of(bpe.encoding_digests(stages[4], VOCABULARY))
    assert rows_of(corpus_pipeline.run(spark, SF)) == rows_of(stages[5])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.filter("false")):
            out = stage(spark, rows, SF)
            assert out.columns == docs.columns
            assert out.count() <= rows.count()
