"""A cleaning pipeline over documents: each stage applies one operator of ``listwright.llm``.

Stages keep the columns of their documents and extra ones, and judge every row they are given. Rows
with a null text are kept as long as a stage has no reason to drop them: the classifier scores them
as empty texts, and to the near-duplicate stage all empty texts are copies of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.llm import bpe, decontaminate, line_dedup, quality, simhash
from listwright.llm.queries import VOCABULARY
from listwright.storage import fresh_path, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, labels)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in the last of them only."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    if "n_chars" not in docs.columns:
        return kept
    kind = docs.schema["n_chars"].dataType
    return kept.withColumn("n_chars", F.char_length("text").cast(kind))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id.

    Rows that share this id are one document: equal rows count once. Rows without an id stay where
    no row of their group has one.
    """
    near = stored(simhash.near_duplicates(docs), "near-duplicates")
    firsts = near.filter("doc_id <=> component").groupBy(F.col("doc_id").alias("_id"))
    ids = firsts.agg(F.count("*").alias("_rows")).hint("shuffle_hash")
    kept = docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"])).drop("_id")
    single = kept.filter("_rows = 1")
    repeated = kept.filter("_rows > 1").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated).drop("_rows")


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark, shift=decontaminate.SHIFT)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of the documents that are left, and of their digests."""
    return bpe.encoding_digests(docs, VOCABULARY)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_leaks),
    ("BPE encoding and decoding", encoded),
]

# SQL has no classifier and no byte-pair encoder; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
