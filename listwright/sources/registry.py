"""The source registry: an ordered list of sources whose position is their priority."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The types a source may have.
SOURCE_TYPES = ("git", "kaggle", "wikidata", "http", "local")

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("slug", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("ref", T.StringType(), False),
        T.StructField("repo", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("access", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("is_email", T.BooleanType(), False),
        T.StructField("path", T.StringType()),
        T.StructField("priority", T.IntegerType(), False),
    ]
)


def source_registry(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """Registry of ``records`` in their order: the earlier source has the higher priority.

    Each record needs ``slug``, ``type`` and ``ref``. Unknown fields, unknown types and a
    slug that occurs twice are errors.
    """
    rows, slugs = [], set()
    fields = [f.name for f in REGISTRY_SCHEMA]
    for priority, record in enumerate(records):
        unknown = set(record) - set(fields)
        missing = {"slug", "type", "ref"} - set(record)
        if unknown or missing:
            raise ValueError(f"source {priority}: unknown {unknown}, missing {missing}")
        if record["type"] not in SOURCE_TYPES:
            raise ValueError(f"source {record['slug']}: unknown type {record['type']}")
        if record["slug"] in slugs:
            raise ValueError(f"source {record['slug']} occurs twice")
        slugs.add(record["slug"])
        row = {"is_email": False, **record, "priority": priority}
        rows.append(tuple(row.get(name) for name in fields))
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def check_registry(registry: DataFrame) -> DataFrame:
    """One row: number of sources, and whether slugs and priorities are unique."""
    return registry.agg(
        F.count("*").alias("n_sources"),
        (F.count_distinct("slug") == F.count("*")).alias("slugs_unique"),
        (F.count_distinct("priority") == F.count("*")).alias("priorities_unique"),
    )
