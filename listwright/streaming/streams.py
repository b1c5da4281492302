"""Streams over a folder of line files.

``stream_dedupe`` keeps every distinct value in its state store: there is no event time, so
nothing ever expires. For a stream without end use ``append_new``, which compares what
arrives with the stored table and keeps no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.operators.dedupe import normalize_names
from listwright.sources.lines import readable
from listwright.storage import fresh_path
from listwright.streaming.known import Arrivals


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of the text files that arrive in a folder: ``(file, value)``."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select(
        F.col("_metadata.file_path").alias("file"), readable("value").alias("value")
    )


def stream_normalize(stream: DataFrame, value: str = "value", mode: str = "repair") -> DataFrame:
    """Plain names of the lines as they arrive, stateless."""
    return normalize_names(stream, mode, value)


def stream_dedupe(stream: DataFrame, key: str = "value") -> DataFrame:
    """Each value once over the life of the stream."""
    return stream.select(key).dropDuplicates([key])


def run_available(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Process everything that has arrived, store it and return the stored table."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "stream")
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{path}-progress")
        .format("parquet")
        .start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def append_new(stream: DataFrame, table: str, key: str = "value") -> None:
    """Append the values of the stream that the stored table lacks.

    The table is laid out by ``write_known``. Batches are kept until they are as large as the table,
    and are compared with it together: see ``known``. When this returns, all of them are stored. A
    batch that is run again adds nothing.
    """
    arriving = stream.select(key)
    arrivals = Arrivals(stream.sparkSession, table, arriving.schema)
    query = (
        arriving.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{table.rstrip('/')}-progress")
        .foreachBatch(lambda batch, _: arrivals.take(batch))
        .start()
    )
    query.awaitTermination()
    arrivals.add()
