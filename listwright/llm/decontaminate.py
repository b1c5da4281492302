"""Benchmark decontamination by the q-gram lemma, and banded alignment of what it leaves.

Texts are compared as UTF-8 in lower case, with every run of ASCII characters other than letters and
digits as one space. A benchmark item is cut into segments that begin every ``shift`` bytes and where
the last one ends with the item; a document is contaminated by an item if a segment occurs in it with
at most ``errors`` of its length in edits. With ``SHIFT``, which is within the edits of a whole
segment, every verbatim excerpt of ``SEGMENT - SHIFT`` bytes is found, wherever in the item it begins;
with ``STEP``, shorter ones than ``SEGMENT + STEP - 20`` bytes only at some places. Segments at every
``STEP`` bytes and the last one are counted; the others between them only tell.

Such an occurrence of a segment of length m with k edits keeps at least m - q + 1 - k q of its
q-grams, on diagonals (place in the document less place in the segment) that span at most k. So
shared q-grams are counted in overlapping bands of diagonals, per item and then, where an item has
enough, per segment; regions that meet the bound are kept, and banded alignment finds the edits of each. Nothing is lost before the alignment.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text (or one item), and each block is
sent to all tasks and held against all documents where they are read; documents are not shuffled.

Null and empty texts match nothing. Items with fewer than ``LEAST`` normalised bytes are too short to
tell and match nothing. Repeated rows of documents are judged one by one, repeated items count once
each.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 8
SEGMENT = 100
STEP = 50
SHIFT = 10
LEAST = 30
ERRORS = 0.1
BLOCK_BYTES = 4_000_000
# Text that a task works on at once; longer texts are cut, with what a segment can span in common.
GROUP_BYTES = 2_000_000
_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_GAP = b"\n"

_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)
)


def normalised(text: str | None) -> bytes:
    text = text or ""
    if not text.isascii():
        text = text.lower()
    return b" ".join(text.encode().translate(_PLAIN).split())


def segments(length: int, shift: int) -> np.ndarray:
    """Where the segments of an item begin; the last one ends where the item ends."""
    last = max(0, length - SEGMENT)
    return np.append(np.arange(0, last, shift), last)


def _codes(text: np.ndarray) -> np.ndarray:
    """The q-gram at each place, as a number."""
    if len(text) < Q:
        return np.zeros(0, np.uint64)
    first = text[:Q].view("<u8")
    return np.lib.stride_tricks.as_strided(first, (len(text) - Q + 1,), (1,)).copy()


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes * _MIX >> np.uint64(64 - _BITS)).astype(np.int32)


class Index(NamedTuple):
    """The q-grams of a block of items, their segments, and what the lemma asks of each segment."""

    text: np.ndarray  # the items, one after the other
    items: np.ndarray  # of each segment: the number of its item
    begins: np.ndarray  # where it begins in the text
    counted: np.ndarray  # whether it is one of those that are counted
    lengths: np.ndarray
    budgets: np.ndarray
    bounds: np.ndarray
    low: np.ndarray  # of each place in the text: the segments that hold its q-gram
    high: np.ndarray
    present: np.ndarray  # a table of hashed q-grams, to pass over most of a text
    grams: np.ndarray  # distinct q-grams, sorted
    starts: np.ndarray  # where the places of each q-gram begin
    places: np.ndarray  # of each occurrence


def build_index(
    items: list[bytes], errors: float = ERRORS, shift: int = STEP
) -> Index | None:
    long = [i for i, item in enumerate(items) if len(item) >= LEAST]
    if not long:
        return None
    text = np.frombuffer(b"".join(items[i] for i in long), np.uint8)
    sizes = np.array([len(items[i]) for i in long])
    ends = np.cumsum(sizes)
    cut = [segments(n, shift) for n in sizes.tolist()]
    counts = np.array([len(c) for c in cut])
    firsts = np.cumsum(counts) - counts
    inner = np.concatenate(cut)
    begins = inner + np.repeat(ends - sizes, counts)
    counted = inner % STEP == 0
    counted[firsts + counts - 1] = True
    lengths = np.repeat(np.minimum(sizes, SEGMENT), counts)
    budgets = np.minimum((lengths * errors).astype(np.int64), (lengths - Q) // Q)
    # All segments of an item are of one length.
    place = np.arange(len(text))
    span = np.repeat(np.minimum(sizes, SEGMENT) - Q, sizes)
    low = np.maximum(np.searchsorted(begins, place - span), np.repeat(firsts, sizes))
    high = np.searchsorted(begins, place, "right")
    places = np.flatnonzero(place + Q <= np.repeat(ends, sizes))
    every = _codes(text)[places]
    order = np.argsort(every, kind="stable")
    grams, first = np.unique(every[order], return_index=True)
    present = np.zeros(1 << _BITS, bool)
    present[_slots(grams)] = True
    return Index(
        text, np.repeat(long, counts), begins, counted, lengths, budgets,
        lengths - Q + 1 - budgets * Q, low.astype(np.int32), high.astype(np.int32),
        present, grams, np.append(first, len(every)), places[order],
    )


def _candidates(text: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Segments and the first diagonals of the bands that hold q-grams enough for them."""
    codes = _codes(text)
    at = np.flatnonzero(index.present[_slots(codes)])
    gram = np.searchsorted(index.grams, codes[at]).clip(max=len(index.grams) - 1)
    hit = index.grams[gram] == codes[at]
    at, gram = at[hit], gram[hit]
    # An occurrence has so many hits within its length at least, whatever the segment.
    least, reach = int(index.bounds.min()), int((index.lengths + index.budgets).max())
    if least > 1 and len(at) >= least:
        dense = np.flatnonzero(at[least - 1 :] - at[: len(at) - least + 1] <= reach)
        marks = np.zeros(len(at) + 1, np.int64)
        np.add.at(marks, dense, 1)
        np.add.at(marks, dense + least, -1)
        keep = np.cumsum(marks[:-1]) > 0
        at, gram = at[keep], gram[keep]
    elif len(at) < least:
        at, gram = at[:0], gram[:0]
    counts = index.starts[gram + 1] - index.starts[gram]
    total = int(counts.sum())
    runs = np.repeat(index.starts[gram] - np.cumsum(counts) + counts, counts) + np.arange(total)
    place = index.places[runs]
    diagonal = np.repeat(at, counts) - place
    some = index.low[place]  # a segment of the item
    band = diagonal // (index.budgets[some] + 1)
    again = diagonal - band * (index.budgets[some] + 1) < index.budgets[some]
    place = np.concatenate([place, place[again]])
    some = np.concatenate([some, some[again]])
    band = np.concatenate([band, band[again] - 1])
    # What all segments of an item have in a band together is too little for most.
    _, group, counts = np.unique(
        _keys(index.items[some], band), return_inverse=True, return_counts=True
    )
    enough = counts[group] >= index.bounds[some]
    place, band = place[enough], band[enough]
    counts = (index.high[place] - index.low[place]).astype(np.int64)
    runs = np.repeat(index.low[place] - np.cumsum(counts) + counts, counts)
    segment = runs + np.arange(len(runs))
    keys, counts = np.unique(_keys(segment, np.repeat(band, counts)), return_counts=True)
    segment, band = keys >> 40, (keys & ((1 << 40) - 1)) - (1 << 35)
    enough = counts >= index.bounds[segment]
    segment, band = segment[enough], band[enough]
    return segment, band * (index.budgets[segment] + 1) + index.begins[segment]


def _keys(number: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Number and band in one; bands may begin before the text, so all are moved up."""
    return number.astype(np.int64) << 40 | (band + (1 << 35))


def _aligned(
    text: np.ndarray, segment: np.ndarray, first: np.ndarray, index: Index
) -> tuple[np.ndarray, np.ndarray]:
    """The least edits of each segment along its band, and where the best alignment ends.

    All candidates go on together, one character of the segments at a time, and those that are over
    their budget everywhere are left behind. An alignment may begin and end on any diagonal of the band.
    """
    width = 2 * int(index.budgets[segment].max()) + 1
    steps = np.arange(width, dtype=np.int16)
    far = np.int16(1 << 12)
    edits, ends = np.full(len(segment), int(far)), np.zeros(len(segment), np.int64)
    live = np.arange(len(segment))
    budgets, lengths, begins = (x[segment] for x in (index.budgets, index.lengths, index.begins))
    outside = steps > 2 * budgets[:, None]
    cost = np.where(outside, far, np.int16(0))
    for i in range(int(lengths.max())):
        place = first[:, None] + i + steps
        inside = (place >= 0) & (place < len(text))
        here = np.where(inside, text[place.clip(0, len(text) - 1)], 0)
        own = index.text[(begins + i).clip(max=len(index.text) - 1)]
        swap = cost + (here != own[:, None])
        swap[:, :-1] = np.minimum(swap[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(swap - steps, axis=1) + steps
        cost[outside] = far
        ended = np.flatnonzero(lengths == i + 1)
        at = cost[ended].argmin(axis=1)
        edits[live[ended]] = cost[ended, at]
        ends[live[ended]] = first[ended] + i + 1 + at
        if i % 8 == 7:
            on = (cost.min(axis=1) <= budgets) & (lengths > i + 1)
            live, first, cost, outside = live[on], first[on], cost[on], outside[on]
            budgets, lengths, begins = budgets[on], lengths[on], begins[on]
    return edits, ends


def find(texts: list[bytes], index: Index) -> list[tuple[int, int, set[int], tuple]]:
    """``(text, item, segments, (between, edits, end))`` of every item found in each of some texts:
    which of its counted segments, and the least edits of one with the end of its first such
    place. ``between`` tells that only others are found, and then the best of these is given."""
    gap = _GAP * (int(index.budgets.max()) + 1)  # no alignment within a budget crosses it
    whole = np.frombuffer(gap.join(texts) + gap, np.uint8)
    segment, first = _candidates(whole, index)
    if len(segment) == 0:
        return []
    edits, ends = _aligned(whole, segment, first, index)
    good = edits <= index.budgets[segment]
    segment, edits, ends = segment[good], edits[good], ends[good]
    starts = np.cumsum([0, *(len(t) + len(gap) for t in texts[:-1])])
    owner = np.searchsorted(starts, ends - 1, "right") - 1
    found: dict[tuple[int, int], list] = {}
    for t, s, e, end in zip(
        owner.tolist(), segment.tolist(), edits.tolist(), (ends - starts[owner]).tolist()
    ):
        between = not index.counted[s]
        known = found.setdefault((t, int(index.items[s])), [set(), (between, e, end)])
        if not between:
            known[0].add(s)
        known[1] = min(known[1], (between, e, end))
    return [(t, item, *k) for (t, item), k in found.items()]


def _pieces(text: bytes) -> list[tuple[int, bytes]]:
    overlap = 2 * SEGMENT
    last = max(1, len(text) - overlap)
    return [
        (s, text[s : s + GROUP_BYTES + overlap]) for s in range(0, last, GROUP_BYTES)
    ] if text else []


def _in_batch(texts: list[str | None], index: Index) -> list[tuple[int, int, int, int, int]]:
    """``find`` over texts of any length, in groups of bounded size."""
    best: dict[tuple[int, int], tuple[set[int], tuple]] = {}
    rows: list[tuple[int, int]] = []
    group: list[bytes] = []
    size = 0

    def flush() -> None:
        for t, item, parts, (between, e, end) in find(group, index):
            row, start = rows[t]
            place = (between, e, end + start)
            known = best.get((row, item), (set(), place))  # from earlier pieces of a long text
            best[row, item] = (known[0] | parts, min(known[1], place))

    for row, text in enumerate(texts):
        for start, piece in _pieces(normalised(text)):
            rows.append((row, start))
            group.append(piece)
            size += len(piece)
            if size >= GROUP_BYTES:
                flush()
                rows, group, size = [], [], 0
    if group:
        flush()
    return [(*pair, len(parts), *place[1:]) for pair, (parts, place) in sorted(best.items())]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    errors: float = ERRORS,
    block_bytes: int = BLOCK_BYTES,
    shift: int = STEP,
) -> DataFrame:
    """One row per row of ``docs`` and item found in it: key, item, ``n_segments`` found,
    ``edits`` of the best one, and where that ends in the
    normalised text (``end``). A passage that holds only segments between the counted ones has 0
    ``n_segments``, and ``edits`` and ``end`` of the best of those."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    name = benchmark.schema[item].dataType.simpleString()
    schema = f"key {kind}, item {name}, n_segments int, edits int, end bigint"
    items = benchmark.select(item, F.col(item_text).alias("t"))
    found = [_found(rows, b, errors, shift, schema) for b in _blocks(items, item, block_bytes)]
    none = docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found, none).withColumnsRenamed({"key": key, "item": item})


def _blocks(items: DataFrame, item: str, block_bytes: int):
    """The benchmark in blocks of about ``block_bytes``, each a table of its own."""
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    number = F.pmod(F.xxhash64(item, "t"), F.lit(max(1, blocks)))
    for block in range(blocks):
        yield items.filter(number == block).toArrow()


def _found(rows: DataFrame, block: pa.Table, errors: float, shift: int, schema: str) -> DataFrame:
    ids = block.column(0).combine_chunks()
    index = build_index([normalised(t) for t in block.column(1).to_pylist()], errors, shift)

    def run(batches):
        for batch in batches:
            met = _in_batch(batch.column(1).to_pylist(), index) if index else []
            if met:
                row, number, *rest = (pa.array(c, pa.int64()) for c in zip(*met))
                n, edits, end = rest
                columns = [batch.column(0).take(row), ids.take(number),
                           n.cast(pa.int32()), edits.cast(pa.int32()), end]
                names = ["key", "item", "n_segments", "edits", "end"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    errors: float = ERRORS,
    block_bytes: int = BLOCK_BYTES,
    shift: int = STEP,
) -> DataFrame:
    """The rows of ``docs`` in which no item is found; judged where they are read, without a join."""
    items = benchmark.select(item, F.col(item_text).alias("t"))
    for block in _blocks(items, item, block_bytes):
        docs = docs.mapInArrow(_filter(docs.columns.index(text), block, errors, shift), docs.schema)
    return docs


def _filter(column: int, block: pa.Table, errors: float, shift: int):
    index = build_index([normalised(t) for t in block.column(1).to_pylist()], errors, shift)

    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            if index:
                met = _in_batch(batch.column(column).to_pylist(), index)
                keep[[m[0] for m in met]] = False
            yield batch.filter(pa.array(keep))

    return run
