"""From line tables to one clean, prioritised list without duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.functions import NAME_STEPS, kinds
from listwright.operators.dedupe import (
    LINE_ORDER,
    dedupe_lines,
    dedupe_per_file,
    dedupe_priority,
    normalize_names,
)
from listwright.operators.emails import EMAIL_PARTS, parse_emails, tag_values
from listwright.operators.joins import with_priority
from listwright.operators.ordering import CHUNK_ROWS, global_ordinal, with_commas
from listwright.operators.stats import source_stats, value_stats
from listwright.sources.lines import add_computed
from listwright.storage import stored


def consolidate(
    lines: DataFrame,
    registry: DataFrame,
    mode: str = "repair",
    order: tuple[str, ...] = LINE_ORDER,
    keep_original: bool = False,
) -> DataFrame:
    """Names of all registered sources, each once, from the source of highest priority:
    ``(nick, *order)``, with ``original`` where wanted.

    One shuffle: the lines are normalised, reduced per task, and merged by name.
    """
    names = normalize_names(with_priority(lines, registry), mode)
    return dedupe_priority(names, order=order, keep=("original",) if keep_original else ())


def consolidate_by_kind(
    raw: DataFrame,
    order: tuple[str, ...] = ("file", "line_no"),
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Distinct lines with their kind and their line in the split list:
    ``(kind, value, chunk, line)``. A line of several kinds has several rows."""
    unique = dedupe_lines(raw, order=order)
    split = with_commas(global_ordinal(unique, order, total="n_lines"), "value", "n_lines", rows)
    return split.select(F.explode(kinds("value")).alias("kind"), "value", "chunk", "line")


def consolidate_emails(email_lines: DataFrame, names: DataFrame) -> DataFrame:
    """Unique emails, local parts, domains, names and names combined with local parts:
    ``(part, value)``, in one pass over each input."""
    tagged = [
        tag_values(parse_emails(email_lines), {**EMAIL_PARTS, "combined": "local_part"}),
        tag_values(names, {"name": "nick", "combined": "nick"}),
    ]
    return tagged[0].unionByName(tagged[1]).distinct()


def stats_report(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """Raw lines, normalised, new and accumulated values per source in priority order.

    The lines are read once; what they come to per file and value is written and read twice.
    """
    named = add_computed(with_priority(lines, registry), "nick", "original", *NAME_STEPS)
    per_file = named.groupBy("source", "priority", "file", "nick").agg(
        F.count("*").alias("n_lines")
    )
    return source_stats(stored(per_file, "per-file"), registry)


def stats_total(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """Normalised and deduplicated totals and the duplicate rate, in one pass."""
    return value_stats(_per_file(lines, registry))


def _per_file(lines: DataFrame, registry: DataFrame) -> DataFrame:
    names = normalize_names(with_priority(lines, registry))
    return dedupe_per_file(names, within=("source", "priority", "file"))
