"""Exact removal of repeated byte strings: suffixes sorted by a merge that knows common prefixes.

A string of ``length`` bytes counts as repeated if it starts at another place too, in the same text
or another. Every such string holds an anchor: of its ``gram``-byte windows the one with the least
hash (equals all count). Equal strings have their anchors at the same offset, so only suffixes that
start at anchors are compared, and of those only anchors whose window occurs more than once.

1. Anchors are found where texts are read; those with a window that occurs once are dropped.
2. Each task sorts its suffixes into runs, one per range of window hashes, and front-codes them: of
   each suffix only what follows the prefix it shares with the one before it. Of suffixes of a run
   that are equal, with equal bytes before them, one stands for all and names the others.
3. A range's runs are merged by a loser tree that carries the length of the prefix shared with the
   last winner: characters up to there are never compared again, and the merge yields the common
   prefix of neighbours.
4. For an anchor, a string that starts d bytes before it is repeated exactly if another anchor has the
   same d bytes before it and the same length - d bytes from it on. The second is a stretch of the
   sorted suffixes. The least and the greatest such d bound what to remove: all such strings hold the
   anchor, so what they cover is one stretch of the text.

Suffixes that start with different windows never meet, so ranges are merged on their own. A null text
is an empty one. Rows with equal texts repeat each other, whatever their keys; matches do not cross
rows. Texts shorter than ``length`` stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.storage import stored

LENGTH = 400
GRAM = 120
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
# Bytes of suffixes that a task sorts at once, and suffixes of a range that is merged at once.
RUN_BYTES = 20_000_000
RANGE_SUFFIXES = 5_000
# Ranges to a task, one after the other.
TASK_RANGES = 6


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = (np.full(n, b, np.uint64) for b in (_BASE, inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(1 << 16)


def window_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every window of ``gram`` bytes, the same for equal windows anywhere."""
    out = []
    step = len(_UP) - gram
    for at in range(0, len(text) - gram + 1, step):
        part = text[at : at + step + gram - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
        n = len(part) - gram + 1
        out.append((sums[gram:] - sums[:-gram])[:n] * _DOWN[:n])
    h = np.concatenate(out) if out else np.zeros(0, np.uint64)
    # Mixed, so that the least hash is no property of the last bytes alone.
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(32)


def _sliding(values: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """The best of each ``width`` neighbours: of running bests from both ends of fixed blocks."""
    n = len(values) - width + 1
    block = np.full(-(-len(values) // width) * width, fill, np.uint64)
    block[: len(values)] = values
    block = block.reshape(-1, width)
    head = best.accumulate(block, axis=1).ravel()
    tail = best.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(tail[:n], head[width - 1 : width - 1 + n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The places that hold the least value of some ``width`` neighbours; equals all count."""
    least = _sliding(values, width, np.minimum, _MASK)
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    return np.flatnonzero(_sliding(around, width, np.maximum, 0) == values)


def anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the anchors of a text, ascending, and their window hashes."""
    if len(text) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = window_hashes(np.frombuffer(text, np.uint8), gram)
    places = _least(hashes, length - gram + 1)
    return places, hashes[places]


class Suffix(NamedTuple):
    """What is sorted: the window hash and the bytes from the anchor on; and what is before it."""

    sorted_by: bytes
    before: bytes  # the bytes before the anchor, the nearest first
    row: int
    place: int


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix of two strings that agree in ``known`` bytes."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    low, high = known, most
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def suffixes(
    text: bytes, places: list[int], row: int, length: int, gram: int
) -> Iterator[Suffix]:
    codes = window_hashes(np.frombuffer(text, np.uint8), gram)[places].tolist()
    for place, code in zip(places, codes):
        before = text[max(0, place - (length - gram)) : place][::-1]
        # Anchors have the least hashes: mixed again, they fill all ranges alike.
        mixed = (code * _BASE & _MASK).to_bytes(8, "big")
        yield Suffix(mixed + text[place : place + length], before, row, place)


def _front_coded(run: list[Suffix]) -> Iterator[tuple[int, bytes, int, bytes]]:
    """What each of the sorted suffixes shares with the one before it, and the rest of it."""
    last, last_before = b"", b""
    for s in run:
        shared = common_prefix(last, s.sorted_by)
        shared_before = common_prefix(last_before, s.before)
        yield shared, s.sorted_by[shared:], shared_before, s.before[shared_before:]
        last, last_before = s.sorted_by, s.before


def _distinct(run: list[Suffix]) -> Iterator[list[Suffix]]:
    """The sorted suffixes that are equal and have equal bytes before them, together."""
    return (list(same) for _, same in groupby(run, key=itemgetter(0, 1)))


class _Run:
    """A front-coded run, read from its start. ``shared`` is what the suffix at hand has in common
    with the last one taken from any run."""

    def __init__(self, rows: list[tuple]) -> None:
        self.rows, self.at, self.sorted_by, self.before, self.shared = rows, -1, b"", b"", 0

    def advance(self) -> bool:
        self.at += 1
        if self.at == len(self.rows):
            return False
        self.shared, tail, shared_before, before_tail = self.rows[self.at][:4]
        self.sorted_by = self.sorted_by[: self.shared] + tail
        self.before = self.before[:shared_before] + before_tail
        return True


def merged(runs: list[list[tuple]]) -> Iterator[tuple[int, bytes, tuple]]:
    """The suffixes of front-coded runs in order, each with the length of the prefix it shares with
    the one before it: a loser tree that compares two suffixes only from what both are known to
    share with the last winner."""
    leaves = [run for run in map(_Run, runs) if run.advance()]
    if not leaves:
        return
    size = 1 << (len(leaves) - 1).bit_length()
    players: list[_Run | None] = [*leaves, *[None] * (size - len(leaves))]
    losers: list[_Run | None] = [None] * size

    def play(a: _Run | None, b: _Run | None) -> tuple[_Run | None, _Run | None]:
        """The winner and the loser, which then shares with the winner what it lost by."""
        if a is None or b is None:
            return (b, a) if a is None else (a, b)
        if a.shared != b.shared:
            return (a, b) if a.shared > b.shared else (b, a)
        known = common_prefix(a.sorted_by, b.sorted_by, a.shared)
        if a.sorted_by[known : known + 1] <= b.sorted_by[known : known + 1]:
            b.shared = known
            return a, b
        a.shared = known
        return b, a

    level = players
    first = size
    while len(level) > 1:
        first //= 2
        results = [play(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        losers[first : first + len(results)] = [loser for _, loser in results]
        level = [winner for winner, _ in results]
    slots = {id(run): size + i for i, run in enumerate(leaves)}
    winner = level[0]
    while winner is not None:
        yield winner.shared, winner.before, winner.rows[winner.at]
        node = slots[id(winner)] // 2
        if not winner.advance():
            winner = None
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def covered(
    shared: np.ndarray,
    befores: list[bytes],
    afters: np.ndarray,
    copies: np.ndarray,
    length: int,
    gram: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted suffixes: those with a repeated string, and how many bytes before the anchor the
    last and the first such string start.

    ``shared`` is the bytes from the anchor on that a suffix shares with the one before it,
    ``afters`` those it has, ``copies`` the number of equal suffixes it stands for.
    """
    n, reach = len(shared), length - gram
    sizes = np.fromiter(map(len, befores), np.int64, n)
    before = np.frombuffer(b"".join(b.ljust(reach, b"\0") for b in befores), np.uint8)
    before = before.reshape(n, reach)
    least, most = np.full(n, -1), np.full(n, -1)
    group = np.cumsum(shared < gram)
    active = np.arange(n)

    def repeated(rows: np.ndarray, back: int, left: np.ndarray) -> np.ndarray:
        """Of some rows, those whose string that starts ``back`` bytes earlier occurs again."""
        stretch = np.cumsum(shared < length - back)[rows].astype(np.uint64)
        key = (left + stretch * np.uint64(0xBF58476D1CE4E5B9)) * np.uint64(_BASE)
        key ^= key >> np.uint64(32)
        usable = np.flatnonzero((sizes[rows] >= back) & (afters[rows] >= length - back))
        _, inverse = np.unique(key[usable], return_inverse=True)
        counts = np.bincount(inverse, copies[rows[usable]])
        return rows[usable[counts[inverse] > 1]]

    def left_hashes(rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        hashed = np.zeros(len(rows), np.uint64)
        columns = np.ascontiguousarray(before[rows].T)
        yield 0, hashed
        for back in range(1, reach + 1):
            hashed = (hashed + columns[back - 1] + np.uint64(1)) * np.uint64(_BASE)
            hashed ^= hashed >> np.uint64(29)
            yield back, hashed

    def note(rows: np.ndarray, back: int) -> None:
        least[rows] = np.where(least[rows] < 0, back, np.minimum(least[rows], back))
        most[rows] = np.maximum(most[rows], back)

    for back, hashed in left_hashes(active):
        if back in (0, reach):
            note(repeated(active, back, hashed), back)
    # Groups in which every suffix is bound on both sides already have nothing more to find.
    open_groups = np.unique(group[(least != 0) | (most != reach)])
    active = np.flatnonzero(np.isin(group, open_groups))
    for back, hashed in left_hashes(active):
        if 0 < back < reach:
            note(repeated(active, back, hashed), back)
    found = np.flatnonzero(most >= 0)
    return found, least[found], most[found]


def _identified(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Key, text, and a hash of the text that tells rows with one key apart."""
    return docs.select(
        F.col(key).alias("key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("version"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )


def _rows(batch: pa.RecordBatch, at_once: int = 64) -> Iterator[tuple]:
    """The rows of a batch; only a few texts of it are held as Python objects at a time."""
    for start in range(0, batch.num_rows, at_once):
        yield from zip(*(c.slice(start, at_once).to_pylist() for c in batch.columns))


def repeated_anchors(
    docs: DataFrame, text: str, key: str, length: int, gram: int
) -> DataFrame:
    """``(key, version, places)``: the anchors whose window occurs more than once."""

    def run(batches):
        for batch in batches:
            for at, (_, _, value) in enumerate(_rows(batch)):
                places, hashes = anchors(value, length, gram)
                if len(places):
                    row = pa.array(np.full(len(places), at))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(row), batch.column(1).take(row),
                         pa.array(places.astype(np.int32)), pa.array(hashes.view(np.int64))],
                        ["key", "version", "place", "h"],
                    )

    kind = docs.schema[key].dataType.simpleString()
    rows = _identified(docs, text, key)
    schema = f"key {kind}, version bigint, place int, h bigint"
    found = stored(rows.mapInArrow(run, schema), "anchors")
    again = found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    # Read from files, both sides of the join are shuffled as they are, and adaptive execution may
    # split the partition of a window that very many documents hold.
    kept = found.join(stored(again, "repeated-windows").hint("merge"), "h")
    return kept.groupBy("key", "version").agg(F.sort_array(F.collect_set("place")).alias("places"))


def sorted_runs(
    texts: DataFrame, ranges: int, length: int, gram: int, run_bytes: int = RUN_BYTES
) -> DataFrame:
    """Front-coded runs of the suffixes of ``texts(key, version, text, places)``, by range."""
    names = ["range", "run", "seq", "shared", "tail", "shared_before", "before_tail", "place",
             "key", "version", "others"]

    def run(batches):
        number = TaskContext.get().partitionId() << 24
        held: list[Suffix] = []
        rows: list[tuple] = []
        size = 0

        def flush(kind: pa.DataType):
            """The suffixes held, as one run per range, in one batch."""
            held.sort()
            same = list(_distinct(held))
            first = [s for s, *_ in same]
            others = [[(*rows[s.row], s.place) for s in more] or None for _, *more in same]
            which = [int.from_bytes(s.sorted_by[:8], "big") * ranges >> 64 for s in first]
            ends = [i for i in range(1, len(first)) if which[i] != which[i - 1]] + [len(first)]
            coded: list[tuple] = []
            for start, end in zip([0, *ends], ends):
                coded += _front_coded(first[start:end])
            shared, tail, shared_before, before_tail = zip(*coded)
            keys, versions = zip(*(rows[s.row] for s in first))
            values = [which, [number] * len(first), range(len(first)), shared, tail, shared_before,
                      before_tail, [s.place for s in first], keys, versions, others]
            other = pa.struct([("key", kind), ("version", pa.int64()), ("place", pa.int32())])
            types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(),
                     pa.binary(), pa.int32(), kind, pa.int64(), pa.list_(other)]
            arrays = [pa.array(v, t) for v, t in zip(values, types)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            kind = batch.column(0).type
            for key, version, text, places in _rows(batch):
                rows.append((key, version))
                for s in suffixes(text, places, len(rows) - 1, length, gram):
                    held.append(s)
                    size += len(s.sorted_by) + len(s.before) + 200
                    if size >= run_bytes:
                        yield flush(kind)
                        number, held, size = number + 1, [], 0
                        rows = [rows[-1]] * len(rows)
            if not held:
                rows = []
        if held:
            yield flush(kind)

    kind = texts.schema["key"].dataType.simpleString()
    return texts.select("key", "version", "text", "places").mapInArrow(
        run,
        "range int, run bigint, seq int, shared int, tail binary, shared_before int, "
        f"before_tail binary, place int, key {kind}, version bigint, "
        f"others array<struct<key: {kind}, version: bigint, place: int>>",
    )


def repeated_stretches(runs: DataFrame, ranges: int, length: int, gram: int) -> DataFrame:
    """``(key, version, start, end)`` to remove, from the runs of each range merged."""
    names = ["key", "version", "start", "end"]

    def of_range(runs: dict[int, list[tuple]], kind: pa.DataType):
        shared, befores, afters, copies, owners = [], [], [], [], []
        for common, before, row in merged(list(runs.values())):
            shared.append(common - 8)
            befores.append(before)
            afters.append(row[0] + len(row[1]) - 8)
            copies.append(1 + len(row[7] or ()))
            owners.append(row[4:8])
        sizes = np.array(afters), np.array(copies)
        out: list[tuple] = []
        for i, least, most in zip(*map(np.ndarray.tolist, covered(
            np.array(shared), befores, *sizes, length, gram
        ))):
            place, key, version, others = owners[i]
            out.append((key, version, place - most, place - least + length))
            for other in others or ():
                at = other["place"]
                out.append((other["key"], other["version"], at - most, at - least + length))
        if out:
            types = (kind, pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        which, kind = None, None
        runs: dict[int, list[tuple]] = {}
        for batch in batches:
            kind = batch.column(8).type
            for number, *row in _rows(batch, 4096):
                if number != which and runs:
                    yield from of_range(runs, kind)
                    runs.clear()
                which = number
                # By run: shared, tail, shared_before, before_tail, place, key, version, others.
                runs.setdefault(row[0], []).append(tuple(row[2:]))
        if runs:
            yield from of_range(runs, kind)

    kind = runs.schema["key"].dataType.simpleString()
    tasks = -(-ranges // TASK_RANGES)
    dealt = runs.repartition(tasks, "range").sortWithinPartitions("range", "run", "seq")
    return dealt.mapInArrow(run, f"key {kind}, version bigint, start bigint, end bigint")


def removals(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    gram: int = GRAM,
    range_suffixes: int = RANGE_SUFFIXES,
    run_bytes: int = RUN_BYTES,
) -> DataFrame:
    """``(key, version, stretches)``: per distinct row with repeats, what to remove of its bytes."""
    anchored = stored(repeated_anchors(docs, text, key, length, gram), "repeated-anchors")
    total = anchored.agg(F.sum(F.size("places"))).first()[0] or 0
    ranges = max(1, -(-total // range_suffixes))
    rows = _identified(docs, text, key)
    same = rows["key"].eqNullSafe(anchored["key"]) & (rows["version"] == anchored["version"])
    texts = rows.join(anchored, same).select(rows["key"], rows["version"], "text", "places")
    runs = sorted_runs(texts, ranges, length, gram, run_bytes)
    stretches = repeated_stretches(runs, ranges, length, gram)
    return stretches.groupBy("key", "version").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("stretches")
    )


def _without(text: bytes, stretches: list[dict] | None) -> tuple[int, int, bytes]:
    """Bytes removed, in how many maximal stretches, and what stays."""
    kept, at, spans, stop = [], 0, 0, -1
    for stretch in stretches or ():
        start, end = stretch["start"], stretch["end"]
        if start > stop:
            spans += 1
            kept.append(text[at:start])
        stop = max(stop, end)
        at = stop
    kept.append(text[at:])
    rest = b"".join(kept)
    return len(text) - len(rest), spans, rest


def kept_digests(
    docs: DataFrame, removed: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_removed``, ``n_spans``, and the SHA-256 of what stays."""

    def run(batches):
        for batch in batches:
            out = []
            for _, value, stretches in _rows(batch):
                n, spans, rest = _without(value, stretches)
                out.append((len(value), n, spans, hashlib.sha256(rest).hexdigest()))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), _DIGEST_TYPES)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], _DIGEST_NAMES)

    rows = _identified(docs, text, key)
    same = rows["key"].eqNullSafe(removed["key"]) & (rows["version"] == removed["version"])
    joined = rows.join(removed, same, "left").select(rows["key"], "text", "stretches")
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return joined.mapInArrow(run, schema).withColumnRenamed("key", key)


_DIGEST_NAMES = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
_DIGEST_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string())
