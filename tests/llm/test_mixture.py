import heapq

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listwright.llm import mixture
from listwright.llm.oracle import ORACLE

from .odd import SENTENCE, odd_documents, rows_of


def highest_quotients(seats, weights):
    won = [0] * len(weights)
    heap = [(-w, i) for i, w in enumerate(weights) if w > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        won[i] += 1
        heapq.heappush(heap, (-weights[i] / (2 * won[i] + 1), i))
    return won


@pytest.mark.parametrize("seats", [0, 1, 2, 7, 20, 21, 399])
def test_apportioned(spark, seats):
    groups = {
        "a": [5.0, 2.0, 1.0], "b": [1.0] * 9, "c": [0.0, 0.0], "d": [1000.0, 0.001, 3.0, 3.0],
        "e": [0.0, 7.0], "f": [0.1 * i * i for i in range(40)],
    }
    rows = [(g, i, w, seats) for g, weights in groups.items() for i, w in enumerate(weights)]
    claims = spark.createDataFrame(rows, "g string, i int, w double, s long")
    quotas = mixture.apportioned(claims, "s", "w", "i", ("g",)).select("g", "i", "quota")
    got = map(tuple, quotas.collect())
    assert sorted(got) == [
        (g, i, n) for g, weights in groups.items()
        for i, n in enumerate(highest_quotients(seats, weights))
    ]


def with_sources(docs, sources):
    n = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(len(sources))).cast("int")
    names = F.array(*[F.lit(s).cast("string") for s in sources])
    return docs.withColumn("source", F.element_at(names, n + 1)).withColumn("size", F.lit("x"))


def held_against_sql(docs, **options):
    got = mixture.mixed(docs, **options).withColumn("taken", mixture.words_taken(F.col("spans")))
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "source", "text").toArrow())
    want = con.sql(ORACLE["op12_mixture"])
    rows = rows_of(got.select(*want.columns))
    assert rows == sorted(want.fetchall(), key=repr)
    return got


@pytest.mark.parametrize(
    "sources", [["b", "a", None], ["only"], ["hot"] * 30 + ["x", "", None, "é", "z"], [None]]
)
def test_mixed(spark, sources):
    texts = [SENTENCE * (i % 40) for i in range(200)] + [SENTENCE * 3000]
    docs = with_sources(odd_documents(spark, texts), sources).repartition(6)
    held_against_sql(docs)


def test_targets(spark):
    sizes = spark.createDataFrame(
        [("a", 10), ("b", 1000), ("c", 100), ("d", 1), ("e", 0), (None, 5000)],
        "source string, size long",
    )
    rows = mixture.source_targets(sizes).orderBy("number").collect()
    # Weights 5, 2, 1, 5, 2, 1; a, d and e end at three times their size, the rest share 6078.
    assert [r.source for r in rows] == ["a", "b", "c", "d", "e", None]
    want = [30, 3000, 300, 3, 0, 6111 - 3333]
    assert [r.target for r in rows] == pytest.approx(want)


def test_near_targets_and_texts(spark):
    docs = with_sources(odd_documents(spark, [SENTENCE * 50] * 200), ["a", "b", "c"])
    docs = docs.dropDuplicates(["doc_id"]).where("doc_id IS NOT NULL")
    mix = held_against_sql(docs).cache()
    totals = docs.join(mix.drop("size"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"))
    for row in totals.collect():
        assert abs(row.taken - row.target) < 0.02 * row.target
    assert mix.where("taken > 3 * size").count() == 0
    texts = mixture.mixed_texts(mix, docs)
    words = texts.groupBy("doc_id").agg(F.sum(F.size(F.split("text", " "))).alias("n"))
    assert rows_of(words) == rows_of(mix.where("taken > 0").select("doc_id", "taken"))
    whole = {r.doc_id: (r.text or "").split() for r in docs.collect()}
    for row in texts.where("length(text) > 0").limit(50).collect():
        part = row.text.split()
        assert whole[row.doc_id][row.start : row.start + len(part)] == part


def test_empty(spark):
    none = pa.table({
        "doc_id": pa.array([], pa.int64()), "source": pa.array([], pa.string()),
        "text": pa.array([], pa.string()),
    })
    assert mixture.mixed(spark.createDataFrame(none)).count() == 0
    held_against_sql(with_sources(odd_documents(spark).where("length(text) < 2"), ["a"]))
