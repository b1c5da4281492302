"""A stored table of known values that grows, and that a batch reads a small part of.

Values lie in folders by their hash. When the folders of a generation are full, the next one has twice
as many, so folders stay of one size and nothing stored is written again. Beside the values lie marks:
a bitmap per folder and slice with one bit per value, which tells most values that a folder does not
hold. A batch opens only the folders that may hold one of its values.

Marks are written before their values. A batch that fails between the two leaves marks without values,
which cost a look into their folder and nothing else; run again, the batch adds what is missing.

A batch with many more values than the table has folders opens nearly all of them. So the batches of a
stream wait beside the table until they are large against it, and are compared together: see ``Arrivals``.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listwright.operators.dedupe import incremental_new

# Folders of the first generation, values a folder is meant for, and bitmaps per folder. A bitmap has
# 32,768 bits, so a full folder calls one in 26 values that it lacks a possible one, and of a batch
# with ``MANY`` values a folder, one in 50 folders has none by chance.
FIRST_FOLDERS = 64
FOLDER_VALUES = 10_000
SLICES = 8
MANY = 100
_BITS = 32_768
_GENERATION = 1 << 40


def _marks(table: str) -> str:
    return f"{table.rstrip('/')}-marks"


def _places(values: DataFrame, key: str, generations: list[int]) -> DataFrame:
    """Where each value would lie in each generation: ``(key, bucket, slice, bit)``."""
    folder, other = F.xxhash64(key), F.xxhash64(F.lit(1), F.col(key))
    buckets = F.array(*(
        F.pmod(folder, F.lit(FIRST_FOLDERS << g)) + g * _GENERATION for g in generations
    ))
    return values.select(
        key, F.explode(buckets).alias("bucket"),
        F.pmod(other, F.lit(SLICES)).cast("int").alias("slice"),
        F.pmod(F.shiftright(other, 8), F.lit(_BITS)).cast("int").alias("bit"),
    )


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def possible_buckets(values: DataFrame, table: str, key: str = "value") -> list[int]:
    """The folders that may hold one of the values, by the marks of the table.

    What the driver gets is one number per folder that has to be opened. For so many values that
    nearly all folders are among them by chance, it is all folders, and no value is looked up.
    """
    spark = values.sparkSession
    generations = sorted(_fill(spark, table))
    if not generations:
        return []
    marks = spark.read.parquet(_marks(table)).select("bucket", "slice", "bits")
    if values.count() >= MANY * (FIRST_FOLDERS << generations[-1]):
        return [row["bucket"] for row in marks.select("bucket").distinct().collect()]
    byte = F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))
    marked = F.expr("shiftright(byte, bit % 8) & 1 = 1")
    found = (
        _places(values, key, generations)
        .join(marks, ["bucket", "slice"])
        .withColumn("byte", F.conv(F.hex(byte), 16, 10).cast("int"))
        .where(marked)
    )
    return [row["bucket"] for row in found.select("bucket").distinct().collect()]


def _fill(spark: SparkSession, table: str) -> dict[int, int]:
    """Values per generation; there are as many generations as doublings of the table."""
    marks = _table(spark, _marks(table), "bucket bigint, n bigint")
    generation = F.floor(F.col("bucket") / _GENERATION).alias("generation")
    rows = marks.groupBy(generation).agg(F.sum("n").alias("n")).collect()
    return {int(row["generation"]): row["n"] for row in rows}


def write_known(values: DataFrame, table: str, key: str = "value") -> None:
    """Append distinct values that the table lacks: ``(value, bucket)``, a folder per bucket."""
    values = values.select(key).persist()
    _write_kept(values, table, key)
    values.unpersist()


def _write_kept(values: DataFrame, table: str, key: str) -> None:
    """``write_known`` for persisted values, which are read three times."""
    count, fill = values.count(), _fill(values.sparkSession, table)
    generation = max(fill, default=0)
    while (FIRST_FOLDERS << generation) * FOLDER_VALUES - fill.get(generation, 0) < count:
        generation += 1
    placed = _places(values, key, [generation])
    marks = placed.groupBy("bucket", "slice").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit").cast("long") + 1)).alias("bits"),
        F.count("*").alias("n"),
    )
    marks.write.mode("append").parquet(_marks(table))
    folders = placed.select(key, "bucket").repartition("bucket")
    folders.write.mode("append").partitionBy("bucket").parquet(table)


def add_unknown(batch: DataFrame, table: str, key: str = "value") -> None:
    """Append the values of a batch that the table lacks."""
    spark = batch.sparkSession
    values = batch.select(key).where(F.col(key).isNotNull()).distinct().persist()
    buckets = possible_buckets(values, table, key)
    kind = values.schema[key].dataType.simpleString()
    known = _table(spark, table, f"`{key}` {kind}, bucket bigint").select(key, "bucket")
    known = known.where(F.col("bucket").isin(buckets)).select(key)
    new = incremental_new(values, known, key).persist()
    new.count()
    values.unpersist()  # so that the two are kept together for one job only
    _write_kept(new, table, key)
    new.unpersist()


class Arrivals:
    """Batches on their way into a stored table, kept in files beside it until they are compared.

    They are compared when they have ``SHARE`` times as many rows as the table has values, or as the
    first generation holds, and at the end. So a comparison reads at most as much of the table as of
    what arrived since the last one, the one at the end apart, however many batches that came in. Files
    are cleared once their values are stored. What a failed stream leaves is compared by the next one;
    what was stored by then is not added again.
    """

    FEWEST = FIRST_FOLDERS * FOLDER_VALUES
    SHARE = 2

    def __init__(self, spark: SparkSession, table: str, schema: StructType) -> None:
        self.spark, self.table, self.schema = spark, table, schema
        self.path = f"{table.rstrip('/')}-waiting"
        self.rows = self._left()
        self.any = self.rows > 0
        self.enough = self._enough()

    def _enough(self) -> int:
        return self.SHARE * max(self.FEWEST, sum(_fill(self.spark, self.table).values()))

    def _read(self, path: str) -> DataFrame:
        reader = self.spark.read.schema(self.schema).option("recursiveFileLookup", True)
        return reader.parquet(path)

    def _left(self) -> int:
        try:
            return self._read(self.path).count()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def take(self, batch: DataFrame) -> None:
        """Keep a batch, and compare those kept so far when there are enough."""
        [key] = self.schema.names
        path = f"{self.path}/{uuid.uuid4().hex}"
        values = batch.select(key).where(F.col(key).isNotNull())
        values.write.option("compression", "zstd").parquet(path)
        self.rows, self.any = self.rows + self._read(path).count(), True
        if self.rows >= self.enough:
            self.add()

    def add(self) -> None:
        """Append the values kept so far that the table lacks."""
        if not self.any:
            return
        add_unknown(self._read(self.path), self.table, *self.schema.names)
        self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(self.path)
        self.rows, self.any, self.enough = 0, False, self._enough()
