"""Text outputs. List order is kept across the part files of an output, by file name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.functions import kinds
from listwright.operators.ordering import CHUNK_ROWS, join_blocks
from listwright.sinks.tables import output_writer


def write_lines(
    df: DataFrame, path: str, value: str = "nick", order: tuple[str, ...] = (), force: bool = False
) -> None:
    """One value per line; ``order`` gives the list order, where it matters."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = output_writer(df.select(value), path, force)
    if writer:
        writer.text(path)


def write_blocks(
    numbered: DataFrame,
    path: str,
    value: str = "nick",
    rows: int = CHUNK_ROWS,
    force: bool = False,
) -> None:
    """``rows`` values per line, joined and ended by a comma."""
    write_lines(join_blocks(numbered, value, rows), path, "line", ("block",), force)


def write_kinds(
    lines: DataFrame,
    path: str,
    value: str = "value",
    order: tuple[str, ...] = (),
    force: bool = False,
) -> None:
    """One folder per kind of line. A line of several kinds is in each of their folders.

    ``order`` gives the list order within a kind. Lines are dealt by kind and value or order, so a
    task writes few files and a common kind has several.
    """
    tagged = lines.select(value, *(c for c in order if c != value), F.explode(kinds(value)).alias("kind"))
    ranged = tagged.repartitionByRange("kind", *(order or (value,)))
    if order:
        ranged = ranged.sortWithinPartitions("kind", *order)
    writer = output_writer(ranged.select("kind", value), path, force)
    if writer:
        writer.partitionBy("kind").text(path)


def write_chunks(chunked: DataFrame, path: str, value: str, force: bool = False) -> None:
    """One folder with one file per chunk, so a file has exactly the lines of its chunk.

    A chunk is written by one task, which its number alone decides; its size is the parameter of
    ``assign_chunks``.
    """
    tasks = int(chunked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunked.repartitionById(tasks, (F.col("chunk") % tasks).cast("int"))
    ordered = dealt.sortWithinPartitions("chunk", "ord")
    writer = output_writer(ordered.select("chunk", value), path, force)
    if writer:
        writer.option("maxRecordsPerFile", 0).partitionBy("chunk").text(path)
