"""The shared folder for intermediate tables, and joins that need a rule of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A registry has at most this many sources; a larger one is an error, not another plan.
REGISTRY_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several results are taken from, and go on from the written files."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def registry_side(registry: DataFrame, most: int = REGISTRY_ROWS) -> DataFrame:
    """A registry, one row per source, as the broadcast side of a join.

    Its rows are counted in the same job; more than ``most`` end the job with an error.
    """
    rows = registry.agg(F.count("*")).scalar()
    too_many = F.raise_error(F.lit(f"a registry has more than {most} rows"))
    return F.broadcast(registry.where(F.when(rows <= most, True).otherwise(too_many)))


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "inner"
) -> DataFrame:
    """A join on columns of equal names where null equals null; the keys of the left stay."""
    named = {key: f"_right_{i}" for i, key in enumerate(keys)}
    other = right.withColumnsRenamed(named)
    same = F.lit(True)
    for key, name in named.items():
        same = same & left[key].eqNullSafe(other[name])
    return left.join(other, same, how).drop(*named.values())
