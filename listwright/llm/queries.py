"""The operators over the test tables, one query per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.llm import (
    alignment, bpe, decontaminate, importance, line_dedup, mixture, prefix_trie, quality, repair,
    simhash, suffix_runs, url_lists, warc,
)
from listwright.storage import fresh_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0")
    return importance.quality_rules(_table(spark, sf_dir, "documents"), trusted)


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.evaluate(url_lists.capture_times(pages), url_lists.dated_list(pages))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.record_index(spark, path).withColumnRenamed("key", "page_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return line_dedup.kept_digests(docs, line_dedup.keep_bitmaps(docs))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
        shift=decontaminate.SHIFT,
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op7_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-shards")
    repair.write_shards(_table(spark, sf_dir, "documents"), path, VOCABULARY)
    return repair.read_documents(spark, path)


def op8_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(_table(spark, sf_dir, "documents"), VOCABULARY)


def op9_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return suffix_runs.kept_digests(docs, suffix_runs.removals(docs))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return near.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = alignment.aligned(_table(spark, sf_dir, "documents"), VOCABULARY, PIECES)
    return docs


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixture.mixed(_table(spark, sf_dir, "documents"))
    return mix.select(
        "doc_id", "size", "source_size", "target", mixture.words_taken(F.col("spans")).alias("taken")
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return prefix_trie.prefix_nodes(prefix_trie.rebuilt(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_url_lists": op2_url_lists,
    "op3_warc": op3_warc,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality": op6_quality,
    "op7_repair": op7_repair,
    "op8_bpe_trie": op8_bpe_trie,
    "op9_suffix_runs": op9_suffix_runs,
    "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment,
    "op12_mixture": op12_mixture,
    "op13_prefix_trie": op13_prefix_trie,
}
