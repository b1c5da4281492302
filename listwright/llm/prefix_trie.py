"""A trie of conversations: the turns that conversations begin with in common are shared nodes.

Conversations are sequences of turns; a turn is known by the SHA-256 of its role and text. Equal
conversations become one row with their count. The distinct ones are range-partitioned and sorted by
their turns, so each run of rows is a shard of neighbouring prefixes, however many conversations
begin alike. A shard packs its trie as a double array, BASE and CHECK, over its own dense turn ids,
and walks all its conversations through it at once, a turn at a time.

Only nodes on the first and the last path of a shard can have conversations in other shards. Shards
give what they know of these upper nodes as partial sums, which are added up by node. What such nodes
themselves give to those above them is added along the paths: each is counted on one path only, and a
running sum from the end of each path tells what lies below.

What moves are digests, 32 bytes a turn, never texts. A shard holds ``shard_turns`` turns and at most
one conversation more, whose digests must fit a task. A node's digest of conversation ids is made
from ids that Spark sorted and joined in pieces; only these pieces pass one after the other.

A null role or text counts as empty. Turns are in the order of their number, nulls first; equal
numbers in the order of their digests; repeated rows are turns of their own. Rows without a
conversation id belong to no conversation. An empty table has no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listwright.storage import stored

# A shard is closed at this many turns, a piece of joined ids at this many ids.
SHARD_TURNS = 200_000
PIECE_IDS = 50_000
# Free slots tried for the children of a node before they are placed behind all others.
TRIES = 50
FAMILY, MOST_SHARED = 5, 9
NO_IDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, at, digest, size)``: the turns of each conversation, from 0 on."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text)
    rows = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("at"), "digest", "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv_id, path, sizes)``: conversations that share the first turns of their family.

    A family are ``FAMILY`` neighbouring ids. A conversation begins with the first ``h`` turns of the
    family's first one, ``h`` below ``MOST_SHARED`` by its id's CRC-32, and goes on with its own turns
    after its first ``h``. It may have no turn left.
    """
    own = stored(numbered_turns(turns), "turns")
    shared = F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED
    convs = own.where("at = 0").select(
        "conv_id", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first")
    )
    heads = own.where(F.col("at") < MOST_SHARED - 1).withColumnRenamed("conv_id", "first")
    turn = F.struct("part", "at", "digest", "size")
    begun = convs.join(heads, "first").where("at < h").withColumn("part", F.lit(0))
    tail = own.where(F.col("at") >= shared).withColumn("part", F.lit(1))
    ids = convs.select("conv_id", F.lit(None).cast(begun.select(turn).schema[0].dataType).alias("t"))
    parts = begun.select("conv_id", turn.alias("t")).unionByName(tail.select("conv_id", turn.alias("t")))
    path = F.array_sort(F.collect_list("t"))
    gathered = parts.unionByName(ids).groupBy("conv_id").agg(path.alias("t"))
    return gathered.select("conv_id", F.col("t.digest").alias("path"), F.col("t.size").alias("sizes"))


def distinct_sequences(convs: DataFrame, piece_ids: int = PIECE_IDS) -> DataFrame:
    """One row per sequence of turns: ``(conv_id, n, ends_sha256, path, sizes)``.

    ``conv_id`` is the smallest of its ``n`` conversations, the digest that of all their ids in
    ascending order, joined by commas.
    """
    key = F.sha2(F.array_join(F.transform("path", F.hex), ""), 256)
    convs = stored(convs.withColumn("key", key), "conversations")

    def pieces(batches) -> Iterator[pa.RecordBatch]:
        # ``held`` are sorted ids of one key, which go on into the next batch.
        held, current = [], None
        for batch in batches:
            out = []
            for key, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != current or len(held) >= piece_ids:
                    if held:
                        out.append((current, held[0], len(held), ",".join(map(str, held))))
                    held, current = [], key
                held.append(number)
            if out:
                yield _batch(out, ("key", "conv_id", "n", "ids"), _PIECES)
        if held:
            out = [(current, held[0], len(held), ",".join(map(str, held)))]
            yield _batch(out, ("key", "conv_id", "n", "ids"), _PIECES)

    def digests(batches) -> Iterator[pa.RecordBatch]:
        names = ("key", "conv_id", "n", "ends_sha256")
        current = None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] == current:
                    count += row[2]
                    sha.update(b"," + row[3].encode())
                    continue
                if current is not None:
                    out.append((current, least, count, sha.hexdigest()))
                current, least, count, sha = *row[:3], hashlib.sha256(row[3].encode())
            if out:
                yield _batch(out, names, _PIECES)
        if current is not None:
            yield _batch([(current, least, count, sha.hexdigest())], names, _PIECES)

    ids = convs.select("key", "conv_id").repartitionByRange("key", "conv_id")
    ids = ids.sortWithinPartitions("key", "conv_id")
    joined = ids.mapInArrow(pieces, "key string, conv_id bigint, n bigint, ids string")
    joined = joined.repartition("key").sortWithinPartitions("key", "conv_id")
    ends = joined.mapInArrow(digests, "key string, conv_id bigint, n bigint, ends_sha256 string")
    return convs.join(ends, ["key", "conv_id"]).drop("key")


_PIECES = (pa.string(), pa.int64(), pa.int64(), pa.string())


def _batch(rows: list[tuple], names: tuple[str, ...], kinds: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], list(names))


class DoubleArray:
    """A trie packed into two arrays: child ``c`` of slot ``s`` is ``base[s] + c`` if its check is ``s``.

    Slot 0 is the root. ``sequences`` hold dense ids and are sorted so that equal prefixes are
    neighbours.
    """

    def __init__(self, sequences: list[list[int]]) -> None:
        # Nodes in the order in which the sequences first reach them, and each one's children.
        children: list[list[int]] = [[]]
        below: list[dict[int, int]] = [{}]
        before, nodes = [], [0]
        for sequence in sequences:
            shared, most = 0, min(len(before), len(sequence))
            while shared < most and before[shared] == sequence[shared]:
                shared += 1
            del nodes[shared + 1 :]
            for code in sequence[shared:]:
                children[nodes[-1]].append(code)
                below[nodes[-1]][code] = len(children)
                nodes.append(len(children))
                children.append([])
                below.append({})
            before = sequence
        self._pack(children, below)

    def _pack(self, children: list[list[int]], below: list[dict[int, int]]) -> None:
        base, check, slots = [0], [-2], [0] * len(children)
        head = 1
        for node, codes in enumerate(children):
            if not codes:
                continue
            codes.sort()
            while head < len(check) and check[head] != -1:
                head += 1
            slot, tried, first = head, 0, codes[0]
            while tried < TRIES:
                if slot >= len(check) or check[slot] == -1:
                    tried += 1
                    at = slot - first
                    if all(at + c >= len(check) or check[at + c] == -1 for c in codes):
                        break
                slot += 1
            else:
                slot = len(check)
            at, parent = slot - first, slots[node]
            grown = at + codes[-1] + 1 - len(check)
            if grown > 0:
                check.extend([-1] * grown)
                base.extend([0] * grown)
            base[parent] = at
            for code in codes:
                check[at + code] = parent
                slots[below[node][code]] = at + code
        self.base, self.check = np.array(base, np.int64), np.array(check, np.int64)

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each slot by each code, -1 where there is none."""
        to = self.base[slots] + codes
        inside = (to >= 1) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(self.check[to] == slots, to, -1)


def shard_rows(
    numbers: np.ndarray, counts: np.ndarray, paths: list[list[bytes]], sizes: np.ndarray,
    ends: list[str], shard: int,
) -> list[tuple]:
    """The nodes of a shard's sorted sequences, and what it knows of the nodes on its edges."""
    known: dict[bytes, int] = {}
    coded = [[known.setdefault(d, len(known)) for d in path] for path in paths]
    trie = DoubleArray(coded)
    lengths = np.array([len(p) for p in paths], np.int64)
    starts = np.cumsum(lengths) - lengths
    codes = np.array([c for path in coded for c in path], np.int64)

    width = len(trie.check)
    n_convs, depth, size = (np.zeros(width, np.int64) for _ in range(3))
    least = np.full(width, np.iinfo(np.int64).max)
    ended = np.full(width, -1)
    n_convs[0], least[0] = counts.sum(), numbers.min()
    slots = np.zeros(len(paths), np.int64)
    reached = np.zeros(len(codes), np.int64)
    live = np.arange(len(paths))
    for at in range(int(lengths.max(initial=0)) + 1):
        done = live[lengths[live] == at]
        ended[slots[done]] = done
        live = live[lengths[live] > at]
        if len(live) == 0:
            break
        turns = starts[live] + at
        to = trie.step(slots[live], codes[turns])
        slots[live] = reached[turns] = to
        np.add.at(n_convs, to, counts[live])
        np.minimum.at(least, to, numbers[live])
        depth[to], size[to] = at + 1, sizes[turns]

    edges = [0] if len(paths) == 1 else [0, len(paths) - 1]
    lines = [[0, *reached[starts[r] : starts[r] + lengths[r]].tolist()] for r in edges]
    upper = np.zeros(width, bool)
    for line in lines:
        upper[line] = True
    used = trie.check >= 0
    inner = used & ~upper
    n_children = np.bincount(trie.check[inner], minlength=width)
    leaves = (inner & (n_children == 0)).astype(np.int64)
    saved = np.where(inner, (n_convs - 1) * size, 0)
    order = np.flatnonzero(used)
    order = order[np.argsort(-depth[order], kind="stable")]
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])

    keys: dict[int, bytes] = {}
    for r, line in zip(edges, lines):
        sha = hashlib.sha256()
        keys[0] = sha.digest()
        for slot, digest in zip(line[1:], paths[r]):
            sha.update(digest)
            keys[slot] = sha.digest()

    def of(slot: int) -> str:
        return ends[ended[slot]] if ended[slot] >= 0 else None

    rows = []
    for s in np.flatnonzero(inner).tolist():
        parent = int(trie.check[s])
        key = keys.get(parent)
        rows.append((
            int(least[s]), int(depth[s]), None if key else int(least[parent]), key, None, None,
            int(n_convs[s]), int(n_children[s]), int(leaves[s]), int(saved[s]), None, of(s),
        ))
    told: set[int] = set()
    for line_number, line in enumerate(lines):
        for at, s in enumerate(line):
            parent_key = keys[line[at - 1]] if at else None
            place = (at, None, parent_key, keys[s], 2 * shard + line_number)
            if s in told:
                rows.append((None, *place, 0, 0, 0, 0, int(size[s]), None))
            else:
                rows.append((
                    int(least[s]), *place, int(n_convs[s]), int(n_children[s]), int(leaves[s]),
                    int(saved[s]), int(size[s]), of(s),
                ))
            told.add(s)
    return rows


_NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, parent_key binary, key binary, "
    "path_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    "size bigint, ends_sha256 string"
)
_NODE_NAMES = tuple(c.split(" ")[0] for c in _NODE.split(", "))
_NODE_KINDS = tuple(
    {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}[c.split(" ")[1]]
    for c in _NODE.split(", ")
)


def _shards(sequences: DataFrame, shard_turns: int) -> DataFrame:
    def run(batches) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 30
        held, turns = [], 0

        def rows():
            numbers, counts, ends, paths, sizes = zip(*held)
            flat = np.array([s for row in sizes for s in row], np.int64)
            found = shard_rows(
                np.array(numbers, np.int64), np.array(counts, np.int64), list(paths), flat,
                list(ends), shard,
            )
            for at in range(0, len(found), 10_000):
                yield _batch(found[at : at + 10_000], _NODE_NAMES, _NODE_KINDS)

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                held.append(row)
                turns += len(row[3]) + 1
                if turns >= shard_turns:
                    yield from rows()
                    shard, held, turns = shard + 1, [], 0
        if held:
            yield from rows()

    ordered = sequences.select("conv_id", "n", "ends_sha256", "path", "sizes")
    ordered = ordered.repartitionByRange("path").sortWithinPartitions("path")
    return ordered.mapInArrow(run, _NODE)


def prefix_nodes(
    convs: DataFrame, shard_turns: int = SHARD_TURNS, piece_ids: int = PIECE_IDS
) -> DataFrame:
    """One row per node of the trie of ``convs(conv_id, path, sizes)``.

    ``conv_id`` is the smallest conversation through the node, ``n_convs`` how many there are,
    ``n_leaves`` the childless nodes of its subtree, ``saved_tokens`` the bytes of last turns that
    the subtree's conversations share, ``ends_sha256`` the digest of those that end here.
    """
    found = stored(_shards(distinct_sequences(convs, piece_ids), shard_turns), "trie-nodes")
    paths = found.where("path_id IS NOT NULL")
    upper = paths.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"), F.min("path_id").alias("owner"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("size").alias("size"), F.max("ends_sha256").alias("ends_sha256"),
    )
    upper = stored(upper, "trie-upper")
    shared = upper.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    upper = upper.join(shared, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    )
    upper = stored(upper.drop("more"), "trie-upper")
    below = Window.partitionBy("path_id").orderBy(F.desc("depth"))
    owned = F.col("path_id") == F.col("owner")
    leaf = F.sum(F.when(owned & (F.col("n_children") == 0), 1).otherwise(0)).over(below)
    bytes_ = F.sum(F.when(owned, (F.col("n_convs") - 1) * F.col("size")).otherwise(0)).over(below)
    on_paths = paths.select("path_id", "key", "depth").join(
        upper.select("key", "owner", "n_children", "n_convs", "size"), "key"
    )
    given = on_paths.select("key", leaf.alias("leaves"), bytes_.alias("bytes")).groupBy("key").agg(
        F.sum("leaves").alias("leaves"), F.sum("bytes").alias("bytes")
    )
    names = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_parent"))
    columns = (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    )
    above = (
        upper.join(given, "key").join(names, "parent_key", "left")
        .withColumn("n_leaves", F.col("n_leaves") + F.col("leaves"))
        .withColumn("saved_tokens", F.col("saved_tokens") + F.col("bytes"))
        .withColumn("parent_conv_id", F.col("of_parent"))
    )
    inner = found.where("path_id IS NULL").join(names, "parent_key", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "of_parent")
    )
    return above.select(*columns).unionByName(inner.select(*columns))
