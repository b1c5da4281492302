from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, DataFrameWriter

from listwright.sources.listing import opened

MARKER = "_SUCCESS"


def finished(path: str) -> bool:
    """Whether an output was written to its end: Spark puts its marker there last."""
    system, place, _ = opened(path)
    return system.get_file_info(f"{place.rstrip('/')}/{MARKER}").type == pafs.FileType.File


def output_writer(df: DataFrame, path: str, force: bool) -> DataFrameWriter | None:
    """The writer of an output, or none where it is finished and not to be replaced.

    What a failed job left at the path is no output: it is replaced, with or without ``force``.
    """
    if not force and finished(path):
        return None
    # A session may mark nothing and overwrite by partition; an output is always written whole.
    return (
        df.write.mode("overwrite")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .option("partitionOverwriteMode", "static")
    )


def write_table(df: DataFrame, path: str, force: bool = False) -> None:
    writer = output_writer(df, path, force)
    if writer:
        writer.parquet(path)
