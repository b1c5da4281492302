"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.storage import stored


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: the smallest node reachable from it.

    Each round joins every link with the smallest neighbour of its ends, so a node's links are
    never gathered in one place. Rounds are written to the shared folder. Links of a node to
    itself and rows with a null end are left out, repeated links count once.
    """
    ends = links.filter("a <> b")
    pairs = stored(
        ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "components",
    )
    state = _state(pairs)
    for _ in range(max_rounds):
        pairs = stored(_small_star(_large_star(pairs)), "components")
        before, state = state, _state(pairs)
        if state == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def _state(pairs: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count("*"), F.bit_xor(mixed), F.min("v"), F.max("u")).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    return (
        both.join(least, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("low"))
    moved = pairs.join(least, "u").filter("v > low").select(F.col("v").alias("u"), "low")
    return moved.unionByName(least).withColumnRenamed("low", "v").distinct()
