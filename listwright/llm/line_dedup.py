"""Repeated lines: hashes in sorted order, first occurrences streamed, keep bitmaps per document.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys of
at least ``min_chars`` characters go on as a 128-bit hash with their document and position. They are
range-partitioned by hash and document and sorted, the largest document of a hash first, so one pass
over a partition meets the document that keeps the line, then the others. The partitions are written
to the shared folder, and a hash that fills several of them is no special case: each partition tells
how many documents its first and last hash has there, and the pass starts from what lies before.

What comes back is one compressed bitmap per document that loses lines. Text is not shuffled until a
caller applies the bitmaps.

A null or empty text is one empty line. Rows that share a key of documents count as one document;
equal rows share a bitmap. A null document key counts as one document, smaller than all others.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = b" \t\n\x0b\x0c\r"


def _line_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    for position, line in enumerate(text.split(b"\n")):
        line = line.strip(SPACE)
        if len(line) >= min_chars:
            line = line.lower()
            if len(line) >= 4 * min_chars or len(line.decode("utf-8", "replace")) >= min_chars:
                yield position, line


def line_hashes(docs: DataFrame, text: str, key: str, min_chars: int) -> DataFrame:
    """``(h1, h2, doc, version, pos)``: the keys that can repeat, hashed to 128 bits.

    ``version`` tells rows with one document key but different texts apart.
    """

    def run(batches):
        for batch in batches:
            rows, digests, positions = [], [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                for position, line in _line_keys(value or b"", min_chars):
                    digests.append(xxhash.xxh3_128_digest(line))
                    rows.append(i)
                    positions.append(position)
            halves = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column(0).take(at),
                 batch.column(2).take(at), pa.array(positions, pa.int32())],
                ["h1", "h2", "doc", "version", "pos"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return _with_version(docs, text, key).mapInArrow(
        run, f"h1 bigint, h2 bigint, doc {kind}, version bigint, pos int"
    )


def _with_version(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("doc"),
        F.col(text).cast("binary").alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("version"),
    )


class _Runs:
    """Hash and document boundaries in a sorted batch, going on from the batch before."""

    def __init__(self, batch: pa.RecordBatch, last: tuple | None) -> None:
        self.h1, self.h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        doc = batch.column(2)
        known = doc.is_valid().to_numpy(zero_copy_only=False)
        self.doc = doc.fill_null(0).to_numpy(zero_copy_only=False)
        same = np.ones(len(self.h1), bool)
        same[1:] = (self.h1[1:] == self.h1[:-1]) & (self.h2[1:] == self.h2[:-1])
        twin = same.copy()
        twin[1:] &= (self.doc[1:] == self.doc[:-1]) & (known[1:] == known[:-1])
        first = (self.h1[0], self.h2[0], self.doc[0], known[0])
        same[0] = last is not None and last[:2] == first[:2]
        twin[0] = last is not None and last == first
        self.new_hash, self.new_doc = ~same, ~twin
        self.last = (self.h1[-1], self.h2[-1], self.doc[-1], known[-1])

    def ranks(self, before: int) -> np.ndarray:
        """The number of the row's document within its hash, from 1; ``before`` come first."""
        seen = np.cumsum(self.new_doc)
        starts = np.where(self.new_hash, seen - 1, 0)
        starts = np.maximum.accumulate(starts)
        first = np.logical_or.accumulate(self.new_hash)
        return np.where(first, seen - starts, seen + before)


def _edges(partition: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per partition: how many documents its first and its last hash have in it."""
    last, count, first, only_first = None, 0, None, True
    for batch in partition:
        if batch.num_rows == 0:
            continue
        runs = _Runs(batch, last)
        ranks = runs.ranks(count)
        if last is None:
            first = [int(runs.h1[0]), int(runs.h2[0]), 0]
        elif runs.new_hash[0]:
            only_first = False
        if only_first:
            ends = np.flatnonzero(runs.new_hash[1:])
            first[2] = int(ranks[ends[0] if len(ends) else -1])
            only_first = len(ends) == 0
        last, count = runs.last, int(ranks[-1])
    if last is not None:
        part = TaskContext.get().partitionId()
        row = [part, *first, int(last[0]), int(last[1]), count, 1 if only_first else 2]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], _EDGE_NAMES)


_LINE = ["doc", "version", "pos"]
_EDGE_NAMES = ["part", "first1", "first2", "first_docs", "last1", "last2", "last_docs", "hashes"]


def _carried(edges: list) -> dict[int, tuple[int, int]]:
    """For each partition: documents of its first hash before it, and of its last hash after it."""
    edges = sorted(edges)
    before, after = {}, {}
    held, count = None, 0
    for part, f1, f2, first_docs, l1, l2, last_docs, hashes in edges:
        before[part] = count if held == (f1, f2) else 0
        count = before[part] + last_docs if hashes == 1 else last_docs
        held = (l1, l2)
    held, count = None, 0
    for part, f1, f2, first_docs, l1, l2, last_docs, hashes in reversed(edges):
        after[part] = count if held == (l1, l2) else 0
        count = after[part] + first_docs if hashes == 1 else first_docs
        held = (f1, f2)
    return {part: (before[part], after[part]) for part in before}


def _dropped(hashes: DataFrame, min_docs: int) -> DataFrame:
    """``(doc, version, pos)`` of the lines to drop, streamed from the sorted hashes."""
    order = ["h1", "h2", F.col("doc").desc_nulls_last()]
    ranged = hashes.repartitionByRange(*order).sortWithinPartitions(*order, "version", "pos")
    # Partitions are kept as they are: a second sampling of ranges could cut them elsewhere.
    ranged = ranged.checkpoint()
    schema = ", ".join(f"{name} bigint" for name in _EDGE_NAMES)
    carried = _carried([tuple(r) for r in ranged.mapInArrow(_edges, schema).collect()])

    def run(batches):
        before, after = carried.get(TaskContext.get().partitionId(), (0, 0))
        last, count, held = None, before, []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            runs = _Runs(batch, last)
            if last is None and before:
                runs.new_hash[0] = False  # the first hash began in the partition before
            ranks = runs.ranks(count)
            number = np.cumsum(runs.new_hash)
            most = np.zeros(number[-1] + 1, np.int64)
            np.maximum.at(most, number, ranks)
            # Lines of the second document on are dropped once the hash has documents enough;
            # until then the few of them there are wait.
            if most[0] >= min_docs:
                yield from held
            if number[-1] or most[0] >= min_docs:
                held = []
            later = ranks >= 2
            enough = most[number] >= min_docs
            lines = pa.RecordBatch.from_arrays([batch.column(i) for i in (2, 3, 4)], _LINE)
            yield lines.filter(pa.array(later & enough))
            wait = later & ~enough & (number == number[-1])
            if wait.any():
                held.append(lines.filter(pa.array(wait)))
            last, count = runs.last, int(ranks[-1])
        if held and count + after >= min_docs:
            yield from held

    kind = hashes.schema["doc"].dataType.simpleString()
    return ranged.mapInArrow(run, f"doc {kind}, version bigint, pos int")


def keep_bitmaps(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    min_chars: int = 20,
    min_docs: int = 3,
) -> DataFrame:
    """``(doc, version, bitmap)`` of documents that lose lines.

    Lines whose key is found in at least ``min_docs`` documents stay in the largest one only. The
    bitmap is compressed and has a one for each line to keep; it ends in the byte of the last line
    to drop, and lines after it stay.
    """
    lines = _dropped(line_hashes(docs, text, key, min_chars), min_docs)
    per_doc = lines.groupBy("doc", "version").agg(F.collect_set("pos").alias("drop"))

    def run(batches):
        for batch in batches:
            maps = []
            for drop in batch.column(2).to_pylist():
                keep = np.ones(max(drop) // 8 * 8 + 8, bool)
                keep[drop] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            columns = [batch.column(0), batch.column(1), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "version", "bitmap"])

    kind = docs.schema[key].dataType.simpleString()
    return per_doc.mapInArrow(run, f"doc {kind}, version bigint, bitmap binary")


def _keep(text: bytes | None, bitmap: bytes | None) -> tuple[int, int, bytes]:
    """Lines before, lines dropped, and the lines that stay, joined again."""
    text = text or b""
    if bitmap is None:
        return text.count(b"\n") + 1, 0, text
    lines = text.split(b"\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[: len(lines)]
    kept = [line for line, stays in zip(lines, keep) if stays] + lines[len(keep) :]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str, key: str) -> DataFrame:
    rows = docs.withColumns({
        _ROW: F.struct(*docs.columns),
        _VERSION: F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    }).select(_ROW, _VERSION)
    same = rows[_ROW][key].eqNullSafe(bitmaps["doc"]) & (rows[_VERSION] == bitmaps["version"])
    return rows.join(bitmaps, same, "left").select(f"{_ROW}.*", F.col("bitmap").alias(_BITMAP))


_ROW, _VERSION, _BITMAP = "_line_dedup_row", "_line_dedup_version", "_line_dedup_bitmap"


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``docs`` with the dropped lines taken from its texts; all columns and rows stay."""
    names = docs.columns
    rows = _with_bitmaps(docs, bitmaps, text, key)

    def run(batches):
        for batch in batches:
            at = batch.schema.names.index(text)
            kind = batch.schema.field(at).type
            maps = batch.column(len(names)).to_pylist()
            texts = batch.column(at).to_pylist()
            kept = [
                value if bitmap is None else _keep(value.encode(), bitmap)[2].decode()
                for value, bitmap in zip(texts, maps)
            ]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(kept, kind)
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, docs.schema)


def kept_digests(
    docs: DataFrame, bitmaps: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per row: key, lines before, lines dropped, and the SHA-256 of the text that stays."""

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            found = [_keep(value, bitmap) for value, bitmap in rows]
            lines, dropped = ([row[i] for row in found] for i in (0, 1))
            hashes = [hashlib.sha256(row[2]).hexdigest() for row in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(hashes, pa.string())],
                ["key", "n_lines", "n_dropped", "kept_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(key, text)
    rows = _with_bitmaps(narrow, bitmaps, text, key).select(
        F.col(key).alias("key"), F.col(text).cast("binary").alias("text"), _BITMAP
    )
    schema = f"key {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
