"""Conflict-free target names for files that share a folder after they are sorted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.functions import stem
from listwright.operators.ordering import group_ordinal
from listwright.sources.lines import add_computed
from listwright.storage import null_safe_join, stored


def conflict_suffix(
    files: DataFrame, within: tuple[str, ...] = ("category",), name: str = "name"
) -> DataFrame:
    """Add ``target``: the name, with ``_1``, ``_2``, ... from the second file of a name on.

    The first file in path order keeps its name. Numbers that make a name some other file
    really has are passed over, so targets are unique. Paths must be unique; a null in
    ``within`` is a group like any other.
    """
    group = (*within, name)
    # Only files of repeated names are put in order; a name is found to be repeated by its count.
    named = stored(files.select(*group, "path"), "file-names")
    counts = named.groupBy(*group).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    counts = stored(counts, "repeated-names")
    again = null_safe_join(named, counts, group, "left_semi")
    ranked = group_ordinal(again, group, ("path",), "_rank")
    repeated = ranked.where(F.col("_rank") > 0)
    taken = stored(_taken_numbers(named, counts, within, name), "taken-numbers")
    names = taken.select(*group).distinct()
    moved = _free_numbers(null_safe_join(repeated, names, group, "left_semi"), taken, group)
    numbers = repeated.select("path", "_rank").join(moved, "path", "left").select(
        "path", F.coalesce("_found", "_rank").alias("_number")
    )
    numbered = files.join(numbers, "path", "left")
    base = stem(name)
    ext = F.substring(F.col(name), F.length(base) + 1, F.length(name))
    renamed = F.concat_ws("", base, F.lit("_"), F.col("_number").cast("string"), ext)
    return numbered.select(
        *files.columns, F.when(F.col("_number") > 0, renamed).otherwise(F.col(name)).alias("target")
    )


def _taken_numbers(
    files: DataFrame, names: DataFrame, within: tuple[str, ...], name: str
) -> DataFrame:
    """Numbers that would turn a repeated name into one that exists."""
    ended = r"_([1-9]\d{0,16})$"
    labelled = add_computed(files.select(*within, name), "_stem", name, stem)
    numbered = labelled.where(F.rlike("_stem", F.lit(ended)))
    ext = F.substring(F.col(name), F.length("_stem") + 1, F.length(name))
    candidates = numbered.select(
        *within,
        F.concat(F.regexp_replace("_stem", ended, ""), ext).alias(name),
        F.regexp_extract("_stem", ended, 1).cast("long").alias("number"),
    )
    return null_safe_join(candidates.distinct(), names, (*within, name), "left_semi")


def _free_numbers(repeated: DataFrame, taken: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """``(path, _found)``: the j-th repeated file of a name gets the j-th number that is not taken.

    That is j plus the count of taken numbers with fewer than j free ones below. Files and
    taken numbers are put into one order, where a file's place is this number less one.
    """
    placed = group_ordinal(taken, group, ("number",), "_i")
    below = placed.select(
        *group,
        (F.col("number") - F.col("_i") - 1).alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast("string").alias("path"),
    )
    waiting = repeated.select(*group, F.col("_rank").alias("_at"), F.lit(0).alias("_kind"), "path")
    merged = group_ordinal(waiting.unionByName(below), group, ("_at", "_kind"), "_place")
    return merged.where(F.col("_kind") == 0).select("path", (F.col("_place") + 1).alias("_found"))
