"""URL filters by dated lists: validity intervals, and an as-of join of captures with entries.

A list is a log: an entry is added or removed at a time. The log becomes intervals in which an entry
is active, and every capture is evaluated against the entries active when it was fetched, not
against today's list. An entry is a domain, which covers the hosts below it, or a host with a path,
which covers that page. The longest active entry decides, and of two as long the allowing one.

Only DataFrame functions are used. The log is reduced to one row per entry and time before it is
ordered, so a hot entry costs its distinct times, not its rows. Captures join by equality on the
entry and a salt, with the interval as a condition; the intervals, which are few beside the captures,
are repeated once per salt, so a domain that holds most captures is spread over the salts.

A null or malformed url has no host and no entries, and is kept. Captures without a time are held
against no entry. Log rows with a null entry, list or time are left out; of an entry's additions and
removals at one time the removal counts. Repeated rows are evaluated one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16
# Scheme, user, host and port; path without query and fragment.
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """The host in lower case, empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def url_entries(url: Column) -> Column:
    """All entries that cover a url: its host, the domains above it, and its host with the path."""
    host = url_host(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        labels, lambda label, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")
    )
    path = F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)
    page = F.when(F.length(path) > 1, F.array(F.concat(host, path))).otherwise(F.array())
    return F.when(host != "", F.array_distinct(F.concat(domains, page))).otherwise(F.array())


def validity_intervals(log: DataFrame) -> DataFrame:
    """``(list, entry, valid_from, valid_to)`` of a log ``(list, entry, added, at)``.

    ``added`` tells additions from removals. An interval ends where the next row of its entry
    begins; the last one is open, its ``valid_to`` is null.
    """
    usable = log.filter("list IS NOT NULL AND entry IS NOT NULL AND at IS NOT NULL")
    states = usable.groupBy("list", F.lower("entry").alias("entry"), "at").agg(
        F.min(F.coalesce("added", F.lit(False))).alias("added")
    )
    times = Window.partitionBy("list", "entry").orderBy("at")
    return (
        states.withColumn("valid_to", F.lead("at").over(times))
        .filter("added")
        .select("list", "entry", F.col("at").alias("valid_from"), "valid_to")
    )


def evaluate(
    captures: DataFrame,
    log: DataFrame,
    key: str = "page_id",
    url: str = "url",
    fetched: str = "fetched_at",
    salts: int = SALTS,
) -> DataFrame:
    """One row per capture: key, ``host``, ``fetched_at``, ``n_active`` (entries that cover it and
    were active), the deciding ``entry`` and ``list``, and ``kept``.

    ``log`` has the lists ``block`` and ``allow``; entries of other lists do not count.
    """
    lists = validity_intervals(log.filter(F.col("list").isin("block", "allow")))
    copies = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = captures.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.col(url).alias("url"),
        F.col(fetched).alias("fetched_at"),
    )
    keys = rows.select(
        "row", "key", "fetched_at",
        url_host(F.col("url")).alias("host"),
        F.pmod("row", F.lit(salts)).cast("int").alias("salt"),
        F.explode_outer(url_entries(F.col("url"))).alias("entry"),
    )
    active = (F.col("fetched_at") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))
    )
    a, b = keys.alias("a"), copies.alias("b")
    met = a.join(
        b, (F.col("a.entry") == F.col("b.entry")) & (F.col("a.salt") == F.col("b.salt")) & active,
        "left",
    )
    best = F.struct(
        F.length("b.entry").alias("size"),
        F.when(F.col("list") == "allow", 1).otherwise(0).alias("allows"),
        F.col("b.entry").alias("entry"),
        F.col("list"),
    )
    verdict = met.groupBy("row").agg(
        F.first("key").alias(key),
        F.first("host").alias("host"),
        F.first("fetched_at").alias("fetched_at"),
        F.count("list").alias("n_active"),
        F.max(F.when(F.col("list").isNotNull(), best)).alias("best"),
    )
    return verdict.select(
        key, "host", "fetched_at", "n_active", "best.entry", "best.list",
        (F.coalesce("best.allows", F.lit(1)) == 1).alias("kept"),
    )


def dated_list(pages: DataFrame, url: str = "url") -> DataFrame:
    """A log for trials, made of a table of pages: each entry that covers a url is, by its MD5,
    on the blocking list or the allowing one or on none, from a day on, for good or for some days.

    Times are seconds since the first of the 300 days of the list.
    """
    entries = pages.select(F.explode(url_entries(F.col(url))).alias("entry")).distinct()
    n = F.conv(F.substring(F.md5("entry"), 1, 7), 16, 10).cast("long")
    rows = entries.select("entry", n.alias("n"))
    day = F.col("n") % 300
    gone = day + 20 + F.col("n") % 90

    def events(name: str, condition: str, added: bool, at: Column) -> DataFrame:
        return rows.filter(condition).select(
            F.lit(name).alias("list"), "entry", F.lit(added).alias("added"),
            (at * 86_400).alias("at"),
        )

    return (
        events("block", "n % 3 = 0", True, day)
        .unionByName(events("block", "n % 3 = 0 AND n % 2 = 0", False, gone))
        .unionByName(events("block", "n % 3 = 0 AND n % 2 = 0 AND n % 5 = 0", True, gone + 15))
        .unionByName(events("allow", "n % 7 = 0", True, (day + 100) % 300))
    )


def capture_times(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """``pages`` with a ``fetched_at`` made of the url and the key, in the seconds of the list."""
    day = F.conv(F.substring(F.md5(F.coalesce(F.col(url), F.lit(""))), 1, 7), 16, 10)
    second = F.coalesce(F.pmod(key, F.lit(86_400)), F.lit(0))
    return pages.withColumn("fetched_at", day.cast("long") % 365 * 86_400 + second)
