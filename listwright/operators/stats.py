"""Counts per source, newly added values, duplicate rate and error summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwright.operators.joins import with_priority


def count_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("n_rows"))


def new_uniques(deduped: DataFrame, registry: DataFrame) -> DataFrame:
    """Values each source was the first to bring, and the running total in priority order:
    ``(slug, priority, n_new, n_total)``. Sources that added nothing are listed as well.

    The running total goes over one row per registered source.
    """
    added = deduped.groupBy("priority").agg(F.count("*").alias("_n"))
    counts = registry.select("slug", "priority").join(added, "priority", "left")
    so_far = Window.orderBy("priority").rowsBetween(Window.unboundedPreceding, 0)
    n_new = F.coalesce("_n", F.lit(0).cast("long"))
    return counts.select("slug", "priority", n_new.alias("n_new")).withColumn(
        "n_total", F.sum("n_new").over(so_far)
    )


def raw_counts(raw: DataFrame, binary: DataFrame | None = None) -> DataFrame:
    """Lines per file: ``(source, file, n_lines)``. ``binary`` lists ``(file)`` to skip;
    they are left out of the counts, so the lines themselves are not joined."""
    counts = raw.groupBy("source", "file").agg(F.count("*").alias("n_lines"))
    if binary is None:
        return counts
    return counts.join(binary.select("file").distinct(), "file", "left_anti").select(
        "source", "file", "n_lines"
    )


def dir_totals(manifest: DataFrame, counts: DataFrame) -> DataFrame:
    """Files, bytes and text lines per source: ``(source, n_files, n_bytes, n_lines)``."""
    files = manifest.groupBy("source").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")
    )
    lines = counts.groupBy("source").agg(F.sum("n_lines").alias("n_lines"))
    return files.join(lines, "source", "left").select(
        "source", "n_files", "n_bytes", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines")
    )


def duplicate_rate(n_normalized: Column, n_deduped: Column) -> Column:
    """Percentage of normalised values that were duplicates, 0 when there are none."""
    rate = (1 - n_deduped / n_normalized) * 100
    return F.when(n_normalized > 0, rate).otherwise(F.lit(0.0))


def run_stats(per_file: DataFrame, deduped: DataFrame) -> DataFrame:
    """One row: ``(n_normalized, n_deduped, duplicate_rate)``.

    The normalised total is that of the uniques of each file.
    """
    rows = per_file.select(F.lit(True).alias("_per_file")).unionByName(
        deduped.select(F.lit(False).alias("_per_file"))
    )
    totals = rows.agg(
        F.count_if("_per_file").alias("n_normalized"),
        F.count_if(~F.col("_per_file")).alias("n_deduped"),
    )
    return totals.withColumn(
        "duplicate_rate", duplicate_rate(F.col("n_normalized"), F.col("n_deduped"))
    )


def value_stats(per_file: DataFrame, key: str = "nick") -> DataFrame:
    """The same row from the uniques of each file alone, in one pass."""
    per_value = per_file.groupBy(key).agg(F.count("*").alias("_n"))
    n_rows = F.coalesce(F.sum("_n"), F.lit(0).cast("long"))
    totals = per_value.agg(n_rows.alias("n_normalized"), F.count("*").alias("n_deduped"))
    return totals.withColumn(
        "duplicate_rate", duplicate_rate(F.col("n_normalized"), F.col("n_deduped"))
    )


def error_summary(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("phase", "reason").agg(F.count("*").alias("n_errors"))


def source_stats(per_file: DataFrame, registry: DataFrame) -> DataFrame:
    """Per registered source: raw lines, uniques per file, new values and running total.

    ``per_file(source, priority, nick, n_lines)`` has a row per value of a file, with the lines
    that hold it; lines without a value are under the empty one.
    """
    named = F.col("nick") != ""
    counts = per_file.groupBy("source").agg(
        F.sum("n_lines").alias("n_raw"), F.count_if(named).alias("n_normalized")
    )
    firsts = per_file.where(named).groupBy("nick").agg(F.min("priority").alias("priority"))
    counted = new_uniques(firsts, registry).withColumnRenamed("slug", "source")
    joined = counted.join(counts, "source", "left")
    return joined.fillna(0, ["n_raw", "n_normalized"]).select(
        "source", "priority", "n_raw", "n_normalized", "n_new", "n_total"
    )


def with_registry_flags(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Priority and email flag of each row's source."""
    return with_priority(df, registry, ("priority", "is_email"))
