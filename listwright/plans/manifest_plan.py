"""What would be done with each file: a plan, nothing is moved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.functions import (
    REPAIR_STEPS,
    extension,
    file_category,
    is_binary_extension,
    is_data_file,
    name_valid,
)
from listwright.operators.file_names import conflict_suffix
from listwright.sources.lines import add_computed


def manifest_plan(manifest: DataFrame) -> DataFrame:
    """Per file: whether it is a data file, binary by name, validly named, its category, and
    the repaired name that no other file of the category gets."""
    checked = manifest.select(
        "source",
        "path",
        "name",
        is_data_file("name").alias("valid"),
        is_binary_extension("ext").alias("is_binary"),
        name_valid("name").alias("name_ok"),
    )
    fixed = add_computed(checked, "repaired", "name", *REPAIR_STEPS)
    kept = F.when(F.col("name_ok"), F.col("name")).otherwise(F.col("repaired"))
    planned = add_computed(fixed, "repaired", kept).withColumn(
        "category", file_category(extension("repaired"))
    )
    return conflict_suffix(planned, name="repaired").select(
        "source", "path", "name", "valid", "is_binary", "name_ok", "category", "target"
    )
