"""Alignment of two tokenizers: where their tokens end together, and which tokens overlap.

Texts are tokenized in groups, and each group is worked on in Arrow as a whole: token lists are
flattened with their parent indices, byte lengths are added up segment by segment, and the ends of
both tokenizers meet in a full outer Acero join on (document, end). Its rows in the order of their
ends are the links: each stretch of bytes between two ends lies in one token of either side. Rows
where both sides end close a group.

Links are counted per block of documents by a grouped table, and the counts of a block's distinct id
pairs are added up by Spark. A pair occurs at most once a block, so no pair is hot. The totals go back
to the block that holds the pair, sorted before the block's links, which are numbers of its pairs; so
what moves is a compressed number a link and one row per block and pair, and a task holds one block at a time.

Special tokens are plain text. Null and empty texts, and texts that one of the tokenizers does not
give back byte for byte, have no tokens: zeros and an empty digest. Repeated rows are aligned and
counted one by one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listwright.llm.words import byte_alphabet
from listwright.storage import stored

# Texts tokenized together, and the links from which on a block is closed; neither changes results.
GROUP_CHARS = 300_000
BLOCK_LINKS = 2_000_000
# The words of ``words.PATTERN`` in a form that is matched faster: letters first, as most words are some.
# No alternative moved before another one that can begin with the same character.
FAST_PATTERN = (
    r" ?\p{L}+|'(?:[sdmt]|ll|ve|re)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s++$|\s+(?!\S)|\s"
)
# Longer runs of white space are left to the slower library, whose pattern does not go deeper with them.
# Such a run covers five places in a row of every hundredth, which is looked at first.
_LONG_SPACE, _SOME_SPACE, _SPACE_STEP = re.compile(r"\s{500}"), re.compile(r"\s{5}"), 100
SPACE_MARK = "▁"


class ByteLevel:
    """A byte-level vocabulary: ids, and the bytes of each token. Special tokens are plain text."""

    def __init__(self, vocabulary: str) -> None:
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        model, special = spec["model"], {t["content"] for t in spec.get("added_tokens", ())}
        to_byte = {c: b for b, c in byte_alphabet().items()}
        self.tokens = [b""] * (1 + max(model["vocab"].values()))
        for token, number in model["vocab"].items():
            if token not in special:
                self.tokens[number] = bytes(to_byte[c] for c in token)
        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        made = [model["vocab"]["".join(pair)] for pair in pairs]
        if made != sorted(made):
            raise ValueError("ids must be in the order of the merges")
        ranks = {t: i for i, t in enumerate(self.tokens) if t}
        self.fast = tiktoken.Encoding("own", pat_str=FAST_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if _SOME_SPACE.search(text[::_SPACE_STEP]) and _LONG_SPACE.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.frombuffer(array("i", ids), np.int32)


def _lists(rows: list) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    if rows and isinstance(rows[0], np.ndarray):
        flat = pa.array(np.concatenate(rows), pa.int32())
    else:
        flat = pa.array(list(chain.from_iterable(rows)), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


class Group(NamedTuple):
    """The alignment of a group of texts; ``codes`` are its links, document by document."""

    n_a: pa.Array
    n_b: pa.Array
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    codes: pa.Array


class Aligner:
    """Two tokenizers, and what Arrow needs of their tokens: bytes, lengths, numbers as text."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        self.a = ByteLevel(byte_level)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_tokens = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i)
            else name.replace(SPACE_MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.sides = [self._side(self.a.tokens), self._side(b_tokens)]
        self.base = len(names)

    @staticmethod
    def _side(tokens: list[bytes]) -> tuple[pa.Array, pa.Array, pa.Array]:
        return (
            pa.array(tokens, pa.binary()), pa.array(map(len, tokens), pa.int64()),
            pa.array(map(str, range(len(tokens))), pa.string()),
        )

    def _ends(self, lists: pa.ListArray, side: int) -> tuple[pa.Array, pa.Array, pa.Array]:
        """Of the tokens of all lists: ids, documents, and the byte in the document they end at."""
        ids, docs = pc.list_flatten(lists), pc.list_parent_indices(lists)
        running = pc.cumulative_sum(pc.take(self.sides[side][1], ids))
        starts = lists.offsets.to_numpy()
        before = np.concatenate([[0], running.to_numpy()])[starts[:-1]]
        return ids, docs, pc.subtract(running, pc.take(pa.array(before), docs))

    def align(self, texts: list[str | None]) -> Group:
        spaced = [" " + t if t else "" for t in texts]
        lists = [
            _lists([self.a.encode(t) for t in spaced]),
            _lists(self.b.encode([t or "" for t in texts], num_threads=1)),
        ]
        whole = pa.array(map(str.encode, spaced), pa.binary())
        same = pc.not_equal(whole, b"")
        for side, found in enumerate(lists):
            parts = pc.take(self.sides[side][0], found.flatten())
            joined = pc.binary_join(pa.ListArray.from_arrays(found.offsets, parts), b"")
            same = pc.and_(same, pc.equal(joined, whole))
        n_a, n_b = (pc.if_else(same, pc.list_value_length(found), 0) for found in lists)
        keep = pc.indices_nonzero(same)
        lists = [found.take(keep) for found in lists]

        tables = []
        for side, found in enumerate(lists):
            ids, docs, ends = self._ends(found, side)
            tables.append(pa.table({"doc": docs, "end": ends, "ab"[side]: ids}))
        links = tables[0].join(tables[1], ["doc", "end"], join_type="full outer", use_threads=False)
        links = links.take(pc.sort_indices(links, [("doc", "ascending"), ("end", "ascending")]))
        docs, a, b = (links[c].combine_chunks() for c in ("doc", "a", "b"))
        with_a, with_b = a.is_valid().to_numpy(False), b.is_valid().to_numpy(False)
        closing = np.flatnonzero(with_a & with_b)
        parts = [
            pc.binary_join(
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(valid)[closing]]).astype(np.int32)),
                    pc.take(self.sides[side][2], ids.drop_null()),
                ), ",",
            )
            for side, (ids, valid) in enumerate([(a, with_a), (b, with_b)])
        ]
        written = pc.binary_join_element_wise(*parts, "|")
        of_doc = docs.to_numpy()
        counts = [np.bincount(of, minlength=len(keep)) for of in (of_doc, of_doc[closing])]
        offsets = np.concatenate([[0], np.cumsum(counts[1])]).astype(np.int32)
        rows = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), written), ";")

        places = keep.to_numpy()
        n_links, n_groups = (np.zeros(len(texts), np.int64) for _ in range(2))
        n_links[places], n_groups[places] = counts
        digests = [""] * len(texts)
        for place, row in zip(places.tolist(), rows):
            digests[place] = hashlib.sha256(row.as_buffer()).hexdigest()
        ids = [pc.cast(pc.fill_null_backward(c), pa.int64()) for c in (a, b)]
        codes = pc.add(pc.multiply(ids[0], self.base), ids[1])
        return Group(n_a, n_b, n_groups, n_links, digests, codes)


@lru_cache(maxsize=2)
def _aligner(byte_level: str, pieces: str) -> Aligner:
    return Aligner(byte_level, pieces)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = (
    "block bigint, pair int, a int, b int, n bigint, part int, keys array<{key}>, "
    + "".join(f"{name} array<bigint>, " for name in _NUMBERS)
    + "groups_sha256 array<string>, links binary"
)


def _blocks(
    docs: DataFrame, byte_level: str, pieces: str, group_chars: int, block_links: int
) -> DataFrame:
    """Per block one row per distinct pair of linked ids, and one per group of documents."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces)
        block, held, links = TaskContext.get().partitionId() << 32, [], 0
        for keys, texts in _groups(batches, group_chars):
            group = aligner.align(texts)
            held.append((keys, group))
            links += len(group.codes)
            if links >= block_links:
                yield from rows(aligner, block, held, keys.type)
                block, held, links = block + 1, [], 0
        if held:
            yield from rows(aligner, block, held, keys.type)

    def rows(aligner: Aligner, block: int, held: list, key: pa.DataType) -> Iterator[pa.RecordBatch]:
        coded = pa.concat_arrays([g.codes for _, g in held]).dictionary_encode()
        # Partial counts of the block; Spark adds up those of all blocks.
        counts = pa.table({"pair": coded.indices}).group_by("pair", use_threads=False)
        counts = counts.aggregate([([], "count_all")])
        pair = counts["pair"].combine_chunks()
        code = pc.take(coded.dictionary, pair)
        first = pc.divide(code, aligner.base)
        second = pc.subtract(code, pc.multiply(first, aligner.base))
        yield _fitted({
            "block": pa.array(np.full(len(pair), block)), "pair": pair,
            "a": pc.cast(first, pa.int32()), "b": pc.cast(second, pa.int32()),
            "n": counts["count_all"].combine_chunks(),
        }, len(pair), key)
        start = 0
        for part, (keys, g) in enumerate(held):
            numbers = coded.indices.slice(start, len(g.codes)).to_numpy().astype("<i4")
            start += len(g.codes)
            yield _fitted({
                "block": pa.array([block]), "part": pa.array([part], pa.int32()),
                "keys": _row(keys), "n_a": _row(pc.cast(g.n_a, pa.int64())),
                "n_b": _row(pc.cast(g.n_b, pa.int64())), "n_groups": _row(pa.array(g.n_groups)),
                "n_links": _row(pa.array(g.n_links)),
                "groups_sha256": _row(pa.array(g.digests, pa.string())),
                "links": pa.array([pa.compress(numbers, "zstd", asbytes=True)], pa.binary()),
            }, 1, key)

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, _BLOCK.format(key=kind))


def _row(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _fitted(columns: dict, rows: int, key: pa.DataType) -> pa.RecordBatch:
    """A batch with all columns of a block's rows, null where none are given."""
    kinds = {
        "block": pa.int64(), "pair": pa.int32(), "a": pa.int32(), "b": pa.int32(), "n": pa.int64(),
        "part": pa.int32(), "keys": pa.list_(key), **dict.fromkeys(_NUMBERS, pa.list_(pa.int64())),
        "groups_sha256": pa.list_(pa.string()), "links": pa.binary(),
    }
    arrays = [
        pa.nulls(rows, kind) if columns.get(name) is None else columns[name]
        for name, kind in kinds.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def _groups(batches, most: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Keys and texts of bounded size together; one text may be larger."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        size = start = 0
        for end, text in enumerate(texts, 1):
            size += len(text or "")
            if size >= most or end == len(texts):
                yield batch.column(0).slice(start, end - start), texts[start:end]
                size, start = 0, end


def aligned(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    text: str = "text",
    key: str = "doc_id",
    group_chars: int = GROUP_CHARS,
    block_links: int = BLOCK_LINKS,
) -> tuple[DataFrame, DataFrame]:
    """The alignment of each document, and how often each pair of ids is linked.

    Documents: key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups_sha256``. Pairs: ``(a, b, total, best)``, where no other ``a`` is linked with this ``b``
    more often.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    blocks = stored(_blocks(rows, byte_level, pieces, group_chars, block_links), "aligned-blocks")
    counted = blocks.where("pair IS NOT NULL").select("block", "pair", "a", "b", "n")
    totals = counted.groupBy("a", "b").agg(F.sum("n").alias("total"))
    # One row per id of the second vocabulary.
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    best = F.col("total") == F.col("highest")
    pairs = totals.join(highest, "b").select("a", "b", "total", best.alias("best"))
    graded = counted.join(pairs, ["a", "b"]).select("block", "pair", "total", "best")
    parts = blocks.where("pair IS NULL").drop("pair", "a", "b", "n")
    stream = graded.unionByName(parts, allowMissingColumns=True)
    order = ("block", F.asc_nulls_last("pair"), "part")
    stream = stream.repartition("block").sortWithinPartitions(*order)
    kind = docs.schema[key].dataType.simpleString()
    numbers = ", ".join(f"{name} bigint" for name in (*_NUMBERS, "n_best", "count_sum"))
    schema = f"key {kind}, {numbers}, groups_sha256 string"
    return stream.mapInArrow(_summed, schema).withColumnRenamed("key", key), pairs


def _summed(batches) -> Iterator[pa.RecordBatch]:
    """Adds up, document by document, the totals of a block's pairs, which come before its links."""
    block, total, best, open_ = None, [], [], False
    for batch in batches:
        of, part = batch.column("block").to_numpy(), batch.column("part").is_valid().to_numpy(False)
        cuts = [0, *np.flatnonzero((np.diff(of) != 0) | part[1:] | part[:-1]) + 1, len(of)]
        for start, end in pairwise(cuts):
            if start == end:
                continue
            if of[start] != block:
                block, total, best, open_ = of[start], [], [], True
            run = batch.slice(start, end - start)
            if not part[start]:
                total.append(run.column("total").to_numpy())
                best.append(run.column("best").to_numpy(False))
                continue
            if open_:
                totals = np.concatenate([np.zeros(0, np.int64), *total])
                bests = np.concatenate([np.zeros(0, bool), *best]).astype(np.int64)
                open_ = False
            n_links = run.column("n_links")[0].values
            size = 4 * pc.sum(n_links, min_count=0).as_py()
            links = pa.decompress(run.column("links")[0].as_buffer(), size, "zstd")
            links = np.frombuffer(links, "<i4")
            ends = np.concatenate([[0], np.cumsum(n_links.to_numpy())])
            running = (np.concatenate([[0], np.cumsum(v[links])]) for v in (bests, totals))
            sums = [np.diff(values[ends]) for values in running]
            yield pa.RecordBatch.from_arrays(
                [
                    run.column("keys")[0].values, *(run.column(n)[0].values for n in _NUMBERS),
                    *map(pa.array, sums), run.column("groups_sha256")[0].values,
                ],
                ["key", *_NUMBERS, "n_best", "count_sum", "groups_sha256"],
            )
