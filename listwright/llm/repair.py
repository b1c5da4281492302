"""Token ids in grammar-compressed shards: Re-Pair per block, read back by expansion lengths.

A shard file is a Parquet table of blocks, in the order of the documents. A block holds whole
documents: their ids one after the other as a sequence of symbols, in which frequent pairs of
symbols were replaced, round by round, by new symbols. ``lefts`` and ``rights`` are the rules of the
new symbols, ``lengths`` the number of ids that each expands to. A document's ids are found by its
offset: the running sum of the symbols' lengths tells which symbols to expand, so one document is
decoded without the rest of its block.

Documents are range-partitioned and sorted by key (nulls first; rows with equal keys in the order of
their texts). Null and empty texts hold only the end id.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from listwright.llm.alignment import ByteLevel
from listwright.llm.words import END_OF_TEXT

# A block is closed at this many ids. New symbols fit the 16 bits of a stored symbol.
BLOCK_IDS = 4_000_000
SYMBOLS = 1 << 16
# Pairs replaced in one round at most, and the count from which a pair is frequent. Rounds go on until
# no pair is, or all symbols are used.
ROUND_RULES = 4096
LEAST_COUNT = 16
_TABLE_BITS = 20


class Grammar(NamedTuple):
    """A compressed sequence: symbols below ``base`` are ids, the rest have a rule each."""

    base: int
    symbols: np.ndarray
    lefts: np.ndarray
    rights: np.ndarray
    lengths: np.ndarray


def _pair_codes(symbols: np.ndarray) -> np.ndarray:
    return symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]


def _slots(codes: np.ndarray) -> np.ndarray:
    """The place of each pair in a table of hashed counts."""
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int32)


def _frequent_pairs(codes: np.ndarray, slots: np.ndarray, most: int, least: int) -> np.ndarray:
    """The most frequent pairs, the most frequent first; ties in the order of the pairs.

    A table of hashed counts, which are never too low, leaves few places to count exactly.
    """
    table = np.bincount(slots, minlength=1 << _TABLE_BITS)
    cut = max(least, int(np.partition(table, -most)[-most]))
    while True:
        pairs, counts = np.unique(codes[(table >= cut)[slots]], return_counts=True)
        pairs, counts = pairs[counts >= cut], counts[counts >= cut]
        if len(pairs) or cut == least:
            return pairs[np.lexsort((pairs, -counts))][:most]
        # All of these places hold several rarer pairs.
        cut = max(least, cut // 2)


def _replace(
    symbols: np.ndarray, codes: np.ndarray, slots: np.ndarray, pairs: np.ndarray, first: int
) -> np.ndarray:
    """The sequence with pair number i replaced by symbol ``first + i``, from left to right.

    Where replaced pairs would overlap, the first of them is taken, then every second one.
    """
    order = np.argsort(pairs)
    ranked = pairs[order]
    maybe = np.zeros(1 << _TABLE_BITS, bool)
    maybe[_slots(pairs)] = True
    at = np.flatnonzero(maybe[slots])
    found = np.searchsorted(ranked, codes[at]).clip(max=len(ranked) - 1)
    hit = ranked[found] == codes[at]
    at, number = at[hit], order[found[hit]]
    if len(at) == 0:
        return symbols
    starts = np.concatenate([[True], np.diff(at) > 1])
    run = at[starts][np.cumsum(starts) - 1]
    taken = (at - run) % 2 == 0
    at, number = at[taken], number[taken]
    out = symbols.copy()
    out[at] = first + number
    keep = np.ones(len(out), bool)
    keep[at + 1] = False
    return out[keep]


def compress(ids: np.ndarray, base: int) -> Grammar:
    """Re-Pair in rounds: each replaces the pairs that are the most frequent at its start."""
    if base > SYMBOLS:
        raise ValueError("ids must fit the 16 bits of a symbol")
    symbols = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    lengths = np.ones(0, np.int64)
    first = base
    while True:
        room = min(ROUND_RULES, SYMBOLS - first)
        if len(symbols) < 2 or room <= 0:
            break
        codes = _pair_codes(symbols)
        slots = _slots(codes)
        pairs = _frequent_pairs(codes, slots, room, LEAST_COUNT)
        if len(pairs) == 0:
            break
        symbols = _replace(symbols, codes, slots, pairs, first)
        ends = np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)]).astype(np.int64)
        known = np.concatenate([np.ones(base, np.int64), lengths])
        lengths = np.concatenate([lengths, known[ends].sum(axis=0)])
        rules.append(ends)
        first += len(pairs)
    both = np.concatenate(rules, axis=1) if rules else np.zeros((2, 0), np.int64)
    return Grammar(base, symbols.astype("<u2"), *both.astype("<u2"), lengths.astype("<u4"))


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Expander:
    """Random access to the ids of a grammar."""

    def __init__(self, grammar: Grammar) -> None:
        base = grammar.base
        self.symbols = grammar.symbols.astype(np.int64)
        lengths = np.concatenate([np.ones(base, np.int64), grammar.lengths.astype(np.int64)])
        self.lengths, self.starts = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.zeros(int(lengths.sum()), np.uint32)
        flat[:base] = np.arange(base, dtype=np.uint32)
        self.flat = flat
        for i, (a, b) in enumerate(zip(grammar.lefts.tolist(), grammar.rights.tolist()), base):
            at, half = self.starts[i], lengths[a]
            flat[at : at + half] = flat[self.starts[a] : self.starts[a] + half]
            flat[at + half : at + lengths[i]] = flat[self.starts[b] : self.starts[b] + lengths[b]]
        self.offsets = np.concatenate([[0], np.cumsum(lengths[self.symbols])])

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to before ``end``; only the symbols over them are expanded."""
        if end <= start:
            return np.zeros(0, np.uint32)
        low = int(np.searchsorted(self.offsets, start, "right")) - 1
        high = int(np.searchsorted(self.offsets, end, "left"))
        part = self.symbols[low:high]
        whole = self.flat[_spread(self.starts[part], self.lengths[part])]
        return whole[start - self.offsets[low] : end - self.offsets[low]]


class Encoder:
    """The ids of whole texts as the tokenizers library gives them; its end-of-text mark is one id."""

    def __init__(self, vocabulary: str) -> None:
        self.parts = ByteLevel(vocabulary)
        self.base = self.parts.library.get_vocab_size()
        self.mark = np.array([self.parts.library.token_to_id(END_OF_TEXT)], np.int32)

    def encode(self, text: str) -> list[np.ndarray]:
        pieces = []
        for i, part in enumerate(text.split(END_OF_TEXT)):
            if i:
                pieces.append(self.mark)
            if part:
                pieces.append(self.parts.encode(part))
        return pieces


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


_BLOCK = (
    "shard int, block int, base int, doc_keys array<{key}>, doc_lengths array<bigint>, "
    "n_tokens bigint, symbols binary, lefts binary, rights binary, lengths binary"
)


def write_shards(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    text: str = "text",
    key: str = "doc_id",
    end_id: int = 0,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode the texts, end each with ``end_id``, and write compressed shards below ``path``."""
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], np.int32)

    def run(batches):
        encoder = _encoder(vocabulary)
        base = encoder.base
        shard, number = TaskContext.get().partitionId(), 0
        keys, lengths, held, size = [], [], [], 0

        def block():
            grammar = compress(np.concatenate(held), base)
            parts = [grammar.symbols, grammar.lefts, grammar.rights, grammar.lengths]
            values = [shard, number, base, keys, lengths, size, *(p.tobytes() for p in parts)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, kinds)], names
            )

        names = [c.split(" ")[0] for c in _BLOCK.split(", ")]
        blob, whole = pa.binary(), pa.int64()
        kinds = None
        for batch in batches:
            kinds = kinds or [pa.int32(), pa.int32(), pa.int32(), pa.list_(batch.column(0).type),
                              pa.list_(whole), whole, blob, blob, blob, blob]
            for value, text in zip(*(column.to_pylist() for column in batch.columns)):
                pieces = [*encoder.encode(text or ""), end]
                keys.append(value)
                lengths.append(sum(map(len, pieces)))
                held.extend(pieces)
                size += lengths[-1]
                if size >= block_ids:
                    yield block()
                    number, keys, lengths, held, size = number + 1, [], [], [], 0
        if held:
            yield block()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    shards = ordered.mapInArrow(run, _BLOCK.format(key=kind))
    shards.write.option("compression", "zstd").parquet(path)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def read_documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the shards: key, ``start`` (ids before it), and its ``n_tokens`` and CRC-32.

    The start adds up three levels: shards, blocks of a shard, documents of a block.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_keys"].dataType.elementType.simpleString()
    sizes = blocks.select("shard", "block", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.sum("n").over(_before(Window.orderBy("shard"))).alias("of_shard")
    )
    starts = sizes.join(shards, "shard").select(
        "shard", "block",
        (F.coalesce("of_shard", F.lit(0))
         + F.coalesce(F.sum("n_tokens").over(
             _before(Window.partitionBy("shard").orderBy("block"))), F.lit(0))).alias("before"),
    )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                grammar = Grammar(row["base"], *(
                    np.frombuffer(row[name], kind) for name, kind in
                    (("symbols", "<u2"), ("lefts", "<u2"), ("rights", "<u2"), ("lengths", "<u4"))
                ))
                expander, at, out = Expander(grammar), 0, []
                for length in row["doc_lengths"]:
                    ids = expander.ids(at, at + length).astype("<u4")
                    out.append((row["shard"], row["block"], at, len(ids), zlib.crc32(ids)))
                    at += length
                columns = [row["doc_keys"], *map(list, zip(*out))]
                arrays = [pa.array(values, t) for values, t in zip(columns, kinds(batch))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    def kinds(batch):
        key_type = batch.schema.field("doc_keys").type.value_type
        return [key_type, pa.int32(), pa.int32(), *[pa.int64()] * 3]

    names = ["key", "shard", "block", "at", "n_tokens", "ids_crc32"]
    schema = f"key {kind}, shard int, block int, at bigint, n_tokens bigint, ids_crc32 bigint"
    decoded = blocks.drop("n_tokens").mapInArrow(run, schema)
    return decoded.join(starts, ["shard", "block"]).select(
        F.col("key").alias(key), (F.col("before") + F.col("at")).alias("start"),
        "n_tokens", "ids_crc32",
    )
