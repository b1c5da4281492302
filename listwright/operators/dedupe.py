"""Normalisation of line tables and every kind of duplicate removal.

Each one aggregates on the value before it shuffles, so a value that makes up a large
part of the rows reaches the shuffle once per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.functions import NAME_STEPS, STRICT_STEPS, is_strict_name, trim_all
from listwright.sources.lines import add_computed, link_titles

LINE_ORDER = ("priority", "file", "line_no")


def normalize_names(lines: DataFrame, mode: str = "repair", value: str = "original") -> DataFrame:
    """Add ``nick``, the plain form of ``value``, and drop the rows where nothing is left.

    ``repair`` deletes the characters a name may not hold. ``strict`` only trims,
    lower-cases and transliterates, and drops what is then no name.
    """
    if mode == "repair":
        return add_computed(lines, "nick", value, *NAME_STEPS).where("nick <> ''")
    if mode == "strict":
        named = add_computed(lines, "nick", value, *STRICT_STEPS)
        return named.where(is_strict_name("nick"))
    raise ValueError(f"unknown mode {mode}")


def link_names(lines: DataFrame, value: str = "original") -> DataFrame:
    """Titles of the links in Markdown lines, as strict names."""
    titles = lines.withColumn(value, link_titles(value))
    return normalize_names(titles, mode="strict", value=value)


def dedupe_per_file(
    names: DataFrame, key: str = "nick", within: tuple[str, ...] = ("source", "file")
) -> DataFrame:
    """Distinct values per file, each with the first line it is on."""
    return names.groupBy(*within, key).agg(F.min("line_no").alias("line_no"))


def dedupe_priority(
    names: DataFrame,
    key: str = "nick",
    order: tuple[str, ...] = LINE_ORDER,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per value: its first occurrence in list order, with ``order`` and ``keep``.

    The kept columns travel with the order in one minimum, so no window and no join is
    needed. ``orderBy(*order)`` gives the list order.
    """
    first = F.min(F.struct(*order, *(c for c in keep if c not in order)))
    return names.groupBy(key).agg(first.alias("first")).select(key, "first.*")


def dedupe_unordered(names: DataFrame, key: str = "nick") -> DataFrame:
    return names.select(key).distinct()


def dedupe_lines(
    lines: DataFrame,
    trim: bool = False,
    value: str = "value",
    order: tuple[str, ...] = ("file", "line_no"),
) -> DataFrame:
    """Distinct lines as they stand, each with its first place.

    With ``trim`` white space is trimmed, blank lines are dropped and no place is kept.
    """
    if trim:
        trimmed = add_computed(lines.select(value), value, value, trim_all)
        return trimmed.where(F.col(value) != "").distinct()
    return dedupe_priority(lines, key=value, order=order)


def incremental_new(batch: DataFrame, seen: DataFrame, key: str = "nick") -> DataFrame:
    """Values of the batch that were not seen before, each once.

    Both sides are reduced to distinct values before the shuffle, and the join reuses
    that partitioning.
    """
    return batch.select(key).distinct().join(seen.select(key).distinct(), key, "left_anti")
