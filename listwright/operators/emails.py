"""Email-shaped values: parsing, unique parts, and the union with the names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.functions import LOCAL_PART_STEPS, domain, is_email, local_part, lower, trim_all
from listwright.sources.lines import add_computed


def parse_emails(lines: DataFrame, value: str = "original") -> DataFrame:
    """Replace ``value`` by ``email``, ``local_part`` and ``domain``; drop what is no email.

    The three stay together on their row.
    """
    kept = [c for c in lines.columns if c != value]
    likely = lines.where(F.contains(F.col(value), F.lit("@")))
    found = add_computed(likely, "email", value, trim_all, lower).where(is_email("email"))
    named = add_computed(found, "local_part", local_part("email"), *LOCAL_PART_STEPS)
    return named.where("local_part <> ''").select(
        *kept, "email", "local_part", domain("email").alias("domain")
    )


EMAIL_PARTS = {"email": "email", "local_part": "local_part", "domain": "domain"}


# Sketches of 2^14 places have a standard error of 0.8 %; this is three times that.
SKETCH_BITS = 14
SKETCH_ERROR = 0.025


def tag_values(df: DataFrame, tags: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Each column of ``tags`` as rows ``(*keep, part, value)`` under its tag, without nulls."""
    pairs = [F.struct(F.lit(t).alias("part"), F.col(c).alias("value")) for t, c in tags.items()]
    return df.select(*keep, F.inline(F.array(*pairs))).where(F.col("value").isNotNull())


def value_sketches(values: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``(*by, sketch)``: what a later count of distinct values needs of each group.

    A sketch takes at most some 16 KB however many values there are. Stored, one per source and
    part, they answer counts over any choice of sources without reading a value again.
    """
    return values.groupBy(*by).agg(F.hll_sketch_agg("value", SKETCH_BITS).alias("sketch"))


def estimated_counts(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, estimate)``: distinct values in all sketches of a group, off by more than
    ``SKETCH_ERROR`` once in some 370 cases."""
    both = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*by).agg(both.alias("estimate"))


def email_uniques(emails: DataFrame) -> DataFrame:
    """Unique emails, local parts and domains as ``(part, value)``, in one pass."""
    return tag_values(emails, EMAIL_PARTS).distinct()


def combine_names(names: DataFrame, emails: DataFrame) -> DataFrame:
    """Names and the local parts of emails, each value once."""
    local_parts = emails.select(F.col("local_part").alias("nick"))
    return names.select("nick").union(local_parts).distinct()


def export_stats(names: DataFrame, emails: DataFrame) -> DataFrame:
    """Unique counts: ``(n_emails, n_local_parts, n_names, n_combined)``.

    Every value is tagged with what it is and reduced to one row before it is counted,
    so no task holds a set of values.
    """
    parts = tag_values(emails, {"email": "email", "local_part": "local_part"})
    values = tag_values(names, {"name": "nick"}).unionByName(parts)
    is_part = {p: F.bool_or(F.col("part") == p) for p in ("email", "local_part", "name")}
    per_value = values.groupBy("value").agg(*(c.alias(p) for p, c in is_part.items()))
    return per_value.agg(
        F.count_if("email").alias("n_emails"),
        F.count_if("local_part").alias("n_local_parts"),
        F.count_if("name").alias("n_names"),
        F.count_if(F.col("local_part") | F.col("name")).alias("n_combined"),
    )
