"""Line tables: one row per value, with the source, the file and the place it came from.

``(file, block, line_no)`` is the place of a line. A text file that Spark cuts into
several blocks has no running line number, so the block's offset comes first and
``line_no`` orders the lines inside it. Tables that carry a line number have no block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.functions import base_name, trim_all
from listwright.functions._columns import ColumnOrName, as_column

FILE_PLACE = ("file", "block", "line_no")

# Fixed value: a Markdown link to a web page, with its title.
LINK = r"\[(.*?)\]\((https?://[^\)]+)\)"
# Bytes of text to a task of ``spread``.
TASK_BYTES = 8_000_000
Step = Callable[[ColumnOrName], Column]


def readable(value: ColumnOrName) -> Column:
    """The value without its undecodable bytes."""
    value = as_column(value)
    repaired = F.replace(F.make_valid_utf8(value), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(value), value).otherwise(repaired)


def scan_raw_lines(
    spark: SparkSession,
    paths: str | list[str],
    source: ColumnOrName | None = None,
    pattern: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Every line of the text files as it stands: ``(source, file, block, line_no, value)``.

    ``pattern`` is a file-name glob such as ``*.txt``; ``source`` is a slug, or a Column
    over ``file`` that derives it.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        readable("value").alias("value"),
    )
    return lines.select(_source_column(source).alias("source"), *FILE_PLACE, "value")


def scan_lines(
    spark: SparkSession,
    paths: str | list[str],
    source: ColumnOrName | None = None,
    pattern: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """One trimmed value per line, blank lines dropped:
    ``(source, file, block, line_no, original)``."""
    return trimmed_lines(scan_raw_lines(spark, paths, source, pattern, recursive))


def trimmed_lines(raw: DataFrame, value: str = "value") -> DataFrame:
    """Trim the values of a raw line table, drop blank ones, call the column ``original``."""
    return add_computed(raw, "original", value, trim_all).drop(value).where("original <> ''")


def lines_from_text(
    df: DataFrame, text: ColumnOrName, source: ColumnOrName, file: ColumnOrName
) -> DataFrame:
    """Explode a text column into raw lines ``(source, file, line_no, value)``.

    A final line break ends the last line, it does not start another one.
    """
    breaks = F.replace(as_column(text), F.lit("\r\n"), F.lit("\n"))
    body = F.replace(breaks, F.lit("\r"), F.lit("\n"))
    unended = F.when(F.endswith("_body", F.lit("\n")), F.substring("_body", F.lit(1), F.length("_body") - 1))
    return (
        df.where(as_column(text) != "")
        .select(as_column(source).alias("source"), as_column(file).alias("file"), body.alias("_body"))
        .withColumn("_body", unended.otherwise(F.col("_body")))
        .select("source", "file", F.posexplode(F.split("_body", "\n")).alias("line_no", "value"))
        .withColumn("line_no", F.col("line_no").cast("long"))
    )


def lines_from_table(
    df: DataFrame, value: ColumnOrName, source: str, line_no: ColumnOrName, file: str = ""
) -> DataFrame:
    """A column of a table as lines ``(source, file, line_no, original)``.

    Values of any type become strings; nested ones become JSON.
    """
    return df.select(
        F.lit(source).alias("source"),
        F.lit(file or source).alias("file"),
        as_column(line_no).cast("long").alias("line_no"),
        to_text(df, value).alias("original"),
    )


def to_text(df: DataFrame, value: ColumnOrName) -> Column:
    c = as_column(value)
    nested = df.select(c).schema[0].dataType.typeName() in ("struct", "array", "map", "variant")
    return F.to_json(c) if nested else c.cast("string")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan of few, large row groups on a key that is unique or nearly so. For inputs
    with tasks enough, leave it out.

    The values are measured first, so that a task gets about ``TASK_BYTES`` of them however large
    the table is: cut into words they take twenty times the memory where they are sorted. Adaptive
    execution, which goes by compressed size, does not join these tasks again.
    """
    if df.isStreaming:
        return df.repartition(*keys)
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    total = df.agg(F.sum(sum(sizes, F.lit(0).cast("long")))).first()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return df.repartition(tasks, *keys)


def merge_lists(
    spark: SparkSession, paths: list[str], source: ColumnOrName | None = None
) -> DataFrame:
    """Lines of the listed files or folders, with their place in the list as ``list_no``.

    A path that does not exist is an error.
    """
    parts = [
        scan_lines(spark, path, source).withColumn("list_no", F.lit(number))
        for number, path in enumerate(paths)
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def link_titles(line: ColumnOrName) -> Column:
    """Title of the first Markdown link to a web page in a line, else null."""
    title = F.regexp_extract(as_column(line), LINK, 0)
    return F.when(title != "", F.regexp_extract(title, r"^\[(.*?)\]\(https?://", 1))


def add_computed(df: DataFrame, name: str, value: ColumnOrName, *steps: Step) -> DataFrame:
    """Add ``steps`` applied to ``value`` one after the other as a column that filters may
    refer to.

    Each step is a projection of its own, whose result later steps use more than once.
    The generator over one element at the end keeps the optimiser from evaluating all
    steps a second time in a filter.
    """
    df = df.withColumn(name, as_column(value))
    for step in steps:
        df = df.withColumn(name, step(name))
    return df.withColumn(name, F.explode(F.array(name)))


def _source_column(source: ColumnOrName | None) -> Column:
    if source is None:
        return base_name("file")
    return F.lit(source) if isinstance(source, str) else source
