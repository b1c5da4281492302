"""Positions in a list: global ordinals, chunks, blocks and ordinals within groups.

The list is range-partitioned and sorted, then written once to the shared folder. A row's
ordinal is the number of rows in the files before its own plus its row number in the file,
which Parquet keeps. No task sees more than its own range, and a lost executor costs a
re-read of the written files.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.functions import chunk_name, strip_commas, trim_all
from listwright.storage import fresh_path, null_safe_join

CHUNK_ROWS = 1_000_000
RAW_CHUNK_ROWS = 5_000_000
SLICE_ROWS = 100_000


def global_ordinal(
    df: DataFrame, order: tuple[str, ...], total: str | None = None
) -> DataFrame:
    """Add ``ord``, the place of each row in ``order`` from 0 on.

    ``total`` names an optional column with the number of rows.
    """
    stored, rows = _sorted_files(df, order)
    spark = df.sparkSession
    starts = list(accumulate((n for _, n in rows), initial=0))
    # One row per written file, so its size is the number of tasks, not of rows.
    offsets = spark.createDataFrame(
        [(name, start) for (name, _), start in zip(rows, starts)],
        T.StructType(
            [T.StructField("_file", T.StringType()), T.StructField("_start", T.LongType())]
        ),
    )
    numbered = stored.join(F.broadcast(offsets), "_file").select(
        *df.columns, (F.col("_start") + F.col("_row")).alias("ord")
    )
    return numbered.withColumn(total, F.lit(starts[-1])) if total else numbered


def _sorted_files(
    df: DataFrame, order: tuple[str, ...]
) -> tuple[DataFrame, list[tuple[str, int]]]:
    """The written list with file and row number, and the row count per file in list order."""
    spark = df.sparkSession
    path = fresh_path(spark, "sorted")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.parquet(path)
    stored = (
        spark.read.schema(df.schema)
        .parquet(path)
        .select(
            "*",
            F.col("_metadata.file_name").alias("_file"),
            F.col("_metadata.row_index").alias("_row"),
        )
    )
    # Files are named by task number, then by their number within the task.
    numbers = [
        F.regexp_extract("_file", r"^part-(\d+)-.*-c(\d+)\.", group).cast("int")
        for group in (1, 2)
    ]
    counts = stored.groupBy("_file").agg(F.count("*").alias("n")).orderBy(*numbers)
    return stored, [(row["_file"], row["n"]) for row in counts.collect()]


def group_ordinal(
    df: DataFrame, group: tuple[str, ...], order: tuple[str, ...], name: str = "ord_in_group"
) -> DataFrame:
    """Add the place of each row within its group, from 0 on.

    A group may be larger than a task: rows get their global ordinal, and the first
    ordinal of a group is joined back per group and slice of 100,000 ordinals. Nulls in
    the group columns are a value like any other.
    """
    numbered = global_ordinal(df, (*group, *order)).withColumn(
        "_slice", F.floor(F.col("ord") / SLICE_ROWS)
    )
    starts = numbered.groupBy(*group).agg(
        F.min("ord").alias("_first"), F.max("_slice").alias("_last_slice")
    )
    slices = F.explode(F.sequence(F.floor(F.col("_first") / SLICE_ROWS), F.col("_last_slice")))
    per_slice = starts.select(*group, "_first", slices.alias("_slice"))
    placed = null_safe_join(numbered, per_slice, (*group, "_slice"))
    return placed.select(*df.columns, (F.col("ord") - F.col("_first")).alias(name))


def assign_chunks(numbered: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``chunk``, from 1 on, with at most ``rows`` rows each, and its ``chunk_file``."""
    chunk = (F.floor(F.col("ord") / rows) + 1).cast("int")
    return numbered.withColumn("chunk", chunk).withColumn("chunk_file", chunk_name("chunk"))


def sample_chunks(numbered: DataFrame, chunks: int, rows: int = CHUNK_ROWS) -> DataFrame:
    """The first ``chunks`` chunks only."""
    return assign_chunks(numbered.where(F.col("ord") < chunks * rows), rows)


def with_commas(
    numbered: DataFrame,
    value: str,
    total: str,
    rows: int = CHUNK_ROWS,
    per_file: bool = False,
) -> DataFrame:
    """Chunks with ``line``: the value and a comma, but none after the last.

    The last is that of the whole list, or with ``per_file`` that of each file as well.
    Values are trimmed unless ``per_file``.
    """
    text = F.col(value) if per_file else trim_all(value)
    last = F.col("ord") == F.col(total) - 1
    line = F.when(last, strip_commas(text))
    if per_file:
        line = line.when(F.col("ord") % rows == rows - 1, text)
    return assign_chunks(numbered, rows).withColumn("line", line.otherwise(F.concat(text, F.lit(","))))


def join_blocks(numbered: DataFrame, value: str = "nick", rows: int = CHUNK_ROWS) -> DataFrame:
    """One line per ``rows`` values, joined and ended by a comma: ``(block, line)``.

    A block never holds more than ``rows`` values.
    """
    block = F.floor(F.col("ord") / rows)
    values = F.array_sort(F.collect_list(F.struct("ord", value)))[value]
    return (
        numbered.groupBy(block.alias("block"))
        .agg(F.concat(F.array_join(values, ","), F.lit(",")).alias("line"))
    )


def trimmed_values(lines: DataFrame, value: str) -> DataFrame:
    """Text input for the blocks: trimmed, blank lines dropped."""
    return lines.withColumn(value, trim_all(value)).where(F.col(value) != "")
