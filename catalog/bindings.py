"""The test tables read as sources, files and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.sources.lines import lines_from_text, spread
from listwright.sources.manifest import manifest_of


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("source", "doc_id", "text"), "doc_id")


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``(source, file, line_no, value)`` of all documents."""
    return lines_from_text(documents(spark, sf), "text", "source", "doc_id")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return raw_lines(spark, sf).withColumnRenamed("value", "original")


def words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all documents, each a line: ``(source, file, line_no, original)``."""
    return _pieces(documents(spark, sf), r"\s+")


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Text between full stops, with the white space around it."""
    return _pieces(documents(spark, sf), r"\.")


def _pieces(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(
        "source",
        F.col("doc_id").alias("file"),
        F.posexplode(F.split("text", pattern)).alias("line_no", "original"),
    ).withColumn("line_no", F.col("line_no").cast("long"))


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """The sources the documents name; the number in the name is the priority."""
    priority = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    return (
        table(spark, sf, "documents")
        .select("source")
        .distinct()
        .select(
            F.col("source").alias("slug"),
            F.lit("local").alias("type"),
            (priority % 5 == 4).alias("is_email"),
            priority.alias("priority"),
        )
    )


def partial_registry(spark: SparkSession, sf: str) -> DataFrame:
    """The registry with some sources left out."""
    return registry(spark, sf).where(F.col("priority") % 7 != 3)


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """A file per page, below its address and of a kind its number tells; the host is the source,
    the page length the file length."""
    pages = table(spark, sf, "pages").select(_page_path().alias("path"), "html")
    paths = pages.groupBy("path").agg(F.sum(F.length("html")).alias("length"))
    return manifest_of(paths, "path", _host("path"), _depth("path"))


def page_lines(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("url", _page_path().alias("path"), "html")
    return lines_from_text(spread(pages, "path"), "html", _host("url"), "path")


def hosts(spark: SparkSession, sf: str) -> DataFrame:
    """The hosts of the pages as a registry."""
    return table(spark, sf, "pages").select(_host("url").alias("slug")).distinct()


def _host(url: str) -> Column:
    return F.regexp_extract(url, r"://([^/]*)", 1)


def _depth(url: str) -> Column:
    return F.size(F.split(url, "/")) - 6


KINDS = ("csv", "txt", "pdf", "html", "zip", "json", "log")


def _page_path() -> Column:
    kind = F.get(F.array(*map(F.lit, KINDS)), (F.col("page_id") % len(KINDS)).cast("int"))
    number = (F.col("page_id") % 3).cast("string")
    return F.concat("url", F.lit("/f"), number, F.lit("."), kind)
