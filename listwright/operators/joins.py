"""Joins with the registry, with the original forms and with the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.operators.dedupe import LINE_ORDER
from listwright.storage import registry_side


def with_priority(
    df: DataFrame,
    registry: DataFrame,
    columns: tuple[str, ...] = ("priority",),
    how: str = "inner",
) -> DataFrame:
    """Rows of registered sources, with ``columns`` of the registry; with ``how="left"`` the rows
    of other sources stay, with nulls."""
    lookup = registry.select(F.col("slug").alias("source"), *columns)
    return df.join(registry_side(lookup), "source", how)


def registered_only(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of registered sources."""
    slugs = registry.select(F.col("slug").alias("source")).distinct()
    return df.join(registry_side(slugs), "source", "left_semi")


def stale_sources(produced: DataFrame, registry: DataFrame) -> DataFrame:
    """Sources that hold data but are not registered: ``(source)``."""
    slugs = registry.select(F.col("slug").alias("source"))
    return produced.select("source").distinct().join(slugs, "source", "left_anti")


def missing_sources(registry: DataFrame, produced: DataFrame) -> DataFrame:
    """Registered sources that produced nothing: ``(slug)``."""
    done = produced.select(F.col("source").alias("slug")).distinct()
    return registry.select("slug").join(done, "slug", "left_anti")


def files_by_source(valid_files: DataFrame, listing: DataFrame) -> DataFrame:
    """Valid files with the source that lists them: ``(source, path)``."""
    return listing.select("source", "path").join(valid_files.select("path"), "path")


def original_forms(names: DataFrame, order: tuple[str, ...] = LINE_ORDER) -> DataFrame:
    """Each name with the original form of its first occurrence in a registered source:
    ``(nick, original)``, in one pass over names whose ``priority`` is null in other sources.

    A name of other sources only keeps itself.
    """
    registered = F.when(F.col("priority").isNotNull(), F.struct(*order, "original"))
    first = names.groupBy("nick").agg(F.min(registered).alias("first"))
    return first.select("nick", F.coalesce("first.original", "nick").alias("original"))


def with_original(
    deduped: DataFrame, normalized: DataFrame, order: tuple[str, ...] = LINE_ORDER
) -> DataFrame:
    """Attach to each name the original form of its first occurrence: ``(nick, original)``.

    A name without one keeps itself. Both sides are unique per name at the join. When the
    names come from the same lines, ``original_forms`` or the ``keep`` of
    ``dedupe_priority`` do this without a join.
    """
    first = F.min(F.struct(*order, "original"))
    originals = normalized.groupBy("nick").agg(first["original"].alias("original"))
    return (
        deduped.select("nick")
        .join(originals, "nick", "left")
        .select("nick", F.coalesce("original", "nick").alias("original"))
    )
