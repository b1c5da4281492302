"""SimHash near-duplicates: a grid join on segment bit counts, then exact verification.

A fingerprint of 64 bits is mapped to the bit counts of its segments. The Manhattan distance of two
such vectors is at most the number of differing bits, so fingerprints ``max_bits`` apart lie within
``max_bits`` of each other on the grid, and at most that many of its coordinates differ. With the
coordinates in ``groups`` groups, two fingerprints in reach share a cell of unit width on all but
``max_bits`` of the groups: each fingerprint enters one cell for every choice of the other groups.
Within a cell, pairs pass the Manhattan bound, then the exact count of differing bits.

A cell with more than ``cell_rows`` fingerprints makes no pairs. Its fingerprints are linked through
the fingerprints half way: two are at most two bits apart exactly if a third is at most one bit from
both, and at most 65 fingerprints lie around one middle.

Equal fingerprints are one node, so copies cost nothing. Null and empty texts have fingerprint zero
and are linked as any other; repeated rows stay rows; a component of null ids has a null id.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.llm.components import connected_components
from listwright.storage import stored

BITS = 64
SEED = 42


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The fingerprint of a text in UTF-8: the majority, bit by bit, of its shingles' XXH64."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int32)
    major = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(major.view("<i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3
) -> DataFrame:
    """One row per row of ``docs``: its key and ``fp``, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(value, shingle) for value in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fp bigint").withColumnRenamed("key", key)


def _counts(fp: Column, segment_bits: int) -> list[Column]:
    mask = (1 << segment_bits) - 1
    shifts = range(0, BITS, segment_bits)
    return [F.bit_count(F.shiftrightunsigned(fp, s).bitwiseAND(F.lit(mask))) for s in shifts]


def _number(counts: list[Column], base: int) -> Column:
    return reduce(add, (c.cast("long") * F.lit(base**i) for i, c in enumerate(counts)))


def near_links(
    fps: DataFrame,
    max_bits: int = 2,
    segment_bits: int = 2,
    groups: int = 4,
    cell_rows: int = 128,
) -> DataFrame:
    """Links ``(a, b)`` that join distinct fingerprints ``fp`` just as all pairs in reach would.

    Pairs of small cells are all there, those of large ones are joined through fewer links.
    """
    if max_bits > 2:
        raise ValueError("large cells are joined exactly for at most two differing bits")
    segments = BITS // segment_bits
    if segments % groups or groups <= max_bits:
        raise ValueError("groups must divide the segments and be more than max_bits")
    each = segments // groups
    grouped = fps.select("fp", *[
        _number(_counts(F.col("fp"), segment_bits)[g * each : (g + 1) * each], segment_bits + 1)
        .alias(f"g{g}") for g in range(groups)
    ])
    cells = [
        F.xxhash64(F.lit(i), *[f"g{g}" for g in kept])
        for i, kept in enumerate(combinations(range(groups), groups - max_bits))
    ]
    # Cells are kept by a hash of their coordinates; cells that meet by chance only make more
    # pairs to verify.
    placed = grouped.select("fp", F.explode(F.array(*cells)).alias("cell"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("size")).filter("size > 1")
    members = stored(placed.join(sizes, "cell"), "simhash-cells")
    small = members.filter(F.col("size") <= cell_rows)
    left = small.select("cell", F.col("fp").alias("a"))
    right = small.select("cell", F.col("fp").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = left.join(right, "cell").filter(F.col("a") < F.col("b"))
    pairs = pairs.filter(_manhattan(segment_bits) <= max_bits).filter(apart <= max_bits)
    large = members.filter(F.col("size") > cell_rows).select("fp").distinct()
    return pairs.select("a", "b").unionByName(_middle_links(large, max_bits))


def _manhattan(segment_bits: int) -> Column:
    """The Manhattan distance of the bit counts of a and b: a lower bound of differing bits."""
    a, b = (_counts(F.col(name), segment_bits) for name in "ab")
    return reduce(add, (F.abs(x - y) for x, y in zip(a, b)))


def _middle_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links over fingerprints one bit away from both ends, or equal to one of them."""
    flips = [0, *(1 << i for i in range(BITS))] if max_bits == 2 else [0]
    signed = [f - (1 << 64) if f >> 63 else f for f in flips]
    if max_bits == 1:
        signed += [f - (1 << 64) if f >> 63 else f for f in (1 << i for i in range(BITS))]
    middles = fps.select("fp", F.explode(F.array(*map(F.lit, signed))).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"), "flip"
    )
    around = middles.groupBy("middle").agg(
        F.min("fp").alias("b"), F.collect_list(F.struct("flip", "fp")).alias("all")
    )
    if max_bits < 2:
        # At one bit the middle must be one of the fingerprints itself.
        around = around.filter(F.exists("all", lambda x: x["flip"] == 0)).withColumn(
            "b", F.col("middle")
        )
    return around.filter(F.size("all") > 1).select(
        F.explode("all.fp").alias("a"), "b"
    ).filter(F.col("a") != F.col("b"))


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shingle: int = 3,
    **grid: int,
) -> DataFrame:
    """Per row of ``docs``: key, ``fp`` and ``component``, the smallest key reachable by links.

    ``grid`` is passed to ``near_links``.
    """
    rows = stored(fingerprints(docs, text, key, shingle), "simhash")
    nodes = rows.groupBy("fp").agg(F.min(key).alias("first"))
    roots = stored(connected_components(near_links(nodes.select("fp"), **grid)), "simhash-roots")
    linked = roots.withColumnRenamed("node", "fp").join(nodes, "fp")
    lowest = linked.groupBy("root").agg(F.min("first").alias("low"))
    reached = linked.join(lowest, "root").select("fp", "low")
    whole = nodes.join(reached, "fp", "left").select(
        "fp", F.coalesce("low", "first").alias("component")
    )
    return rows.join(whole, "fp").select(key, "fp", "component")
