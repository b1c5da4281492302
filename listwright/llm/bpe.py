"""BPE encoding by a trie of distinct words, each shared prefix worked out once, and decoding.

The last token of a word's encoding depends only on the word's prefix: of the vocabulary tokens
that end there, it is the only one that stays apart from the last token of what comes before it.
So the last tokens of all prefixes, kept along a path of the trie, give every encoding below it.
Distinct words in sorted order are a depth-first walk of their trie: the path shared with the word
before is kept as it is, and only the new characters are worked out.

Texts are encoded where they are: each task walks the trie of the words that it has not met yet,
and no text or word is shuffled.

Null and empty texts have no ids. A text may hold the end-of-text mark, which is one id, as in the
tokenizers library. Repeated rows are encoded one by one, other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.llm.words import END_OF_TEXT, WordEncoder, byte_alphabet

_NEVER = 1 << 60


class BpeTrie:
    """A byte-level BPE vocabulary: encodes sorted words along their trie, and decodes ids."""

    def __init__(self, vocabulary: str) -> None:
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        to_byte = {c: b for b, c in byte_alphabet().items()}
        self.text = {i: bytes(to_byte[c] for c in t) for t, i in model["vocab"].items()}
        ids = model["vocab"]
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = ids[left], ids[right], ids[left + right]
            self.merge[a, b] = rank
            self.parts.setdefault(made, (a, b))
            self.rank.setdefault(made, rank)
        self.known: dict[tuple[int, int], bool] = {}
        self.ids = {
            text: i
            for i, text in self.text.items()
            if i not in self.parts or self._apart(*self.parts[i], self.rank[i], False)
        }
        self.longest = max(map(len, self.ids))
        for token in spec.get("added_tokens", ()):
            self.text[token["id"]] = token["content"].encode()
            if token["content"] == END_OF_TEXT:
                self.end_of_text = struct.pack("<I", token["id"])

    def _apart(self, a: int, b: int, limit: int, also_at: bool) -> bool:
        """Whether no merge joins the ends of a and b before merge number ``limit``.

        Merges run in the order of their numbers, so going back through the merges that made the
        two tokens, the latest first, meets every pair of ends that once stood side by side.
        Of equal numbers the left one runs first: a merge across also loses to ``b``'s own merge
        of that number only if it is not before it, which ``also_at`` says.
        """
        merge, rank = self.merge, self.rank
        while True:
            joined = merge.get((a, b))
            if joined is not None and (joined < limit or also_at and joined == limit):
                return False
            of_a, of_b = rank.get(a, -1), rank.get(b, -1)
            if of_a < 0 and of_b < 0:
                return True
            if of_a > of_b:
                limit, also_at, a = of_a, False, self.parts[a][1]
            else:
                limit, also_at, b = of_b, True, self.parts[b][0]

    def _fits(self, a: int, b: int) -> bool:
        fits = self.known.get((a, b))
        if fits is None:
            if len(self.known) > 1_000_000:
                self.known.clear()
            fits = self.known[a, b] = self._apart(a, b, _NEVER, False)
        return fits

    def encode_sorted(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of each of the sorted words, as little-endian unsigned 32-bit integers."""
        ids, fits, longest = self.ids.get, self._fits, self.longest
        known = self.known.get
        # For each prefix of the path: the last token of its encoding, and where that starts.
        path, starts, before = [-1], [0], b""
        pack = struct.Struct("<I").pack
        for word in words:
            shared, most = 0, min(len(before), len(word))
            if before[:most] == word[:most]:
                shared = most
            else:
                while before[shared] == word[shared]:
                    shared += 1
            del path[shared + 1 :], starts[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                # Exactly one token fits, so the likeliest are tried first: the last token made
                # longer, then the shorter ones.
                start = starts[-1]
                token = ids(word[start:end])
                if token is None or start and not fits(path[start], token):
                    for start in range(end - 1, max(0, end - longest) - 1, -1):
                        token = ids(word[start:end])
                        if token is not None:
                            if start == 0:
                                break
                            pair = path[start], token
                            fit = known(pair)
                            if fit or fit is None and fits(*pair):
                                break
                path.append(token)
                starts.append(start)
            before = word
            found, end = [], len(word)
            while end:
                found.append(pack(path[end]))
                end = starts[end]
            found.reverse()
            yield b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.text.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> tuple[BpeTrie, WordEncoder]:
    trie = BpeTrie(vocabulary)
    return trie, WordEncoder(trie.encode_sorted, trie.end_of_text)


def encode_texts(
    docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: its key and ``ids``, little-endian unsigned 32-bit integers."""

    def run(batches):
        _, encoder = _encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _parts(batch.column(0), encoder.encode(texts)):
                yield pa.RecordBatch.from_arrays(part, ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode_ids(ids: DataFrame, vocabulary: str, key: str = "doc_id") -> DataFrame:
    """The texts of a table of keys and ids, as ``encode_texts`` returns them, as binary UTF-8."""

    def run(batches):
        trie, _ = _encoder(vocabulary)
        for batch in batches:
            texts = (trie.decode(value or b"") for value in batch.column(1).to_pylist())
            for part in _parts(batch.column(0), texts):
                yield pa.RecordBatch.from_arrays(part, ["key", "text"])

    kind = ids.schema[key].dataType.simpleString()
    rows = ids.select(F.col(key).alias("key"), "ids")
    return rows.mapInArrow(run, f"key {kind}, text binary").withColumnRenamed("key", key)


def encoding_digests(
    docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per row: ``n_tokens``, and the SHA-256 of the ids and of the text decoded from them."""

    def run(batches):
        trie, encoder = _encoder(vocabulary)
        sha = hashlib.sha256
        for batch in batches:
            rows = [
                (len(ids) // 4, sha(ids).hexdigest(), sha(trie.decode(ids)).hexdigest())
                for ids in encoder.encode(batch.column(1).to_pylist())
            ]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), _DIGESTS)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], _DIGEST_NAMES)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


_DIGESTS = (pa.int64(), pa.string(), pa.string())
_DIGEST_NAMES = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]


def _parts(keys: pa.Array, values: Iterator[bytes], most: int = 16_000_000):
    """Columns of keys and values, in pieces of bounded size."""
    held, size, start = [], 0, 0
    for value in values:
        held.append(value)
        size += len(value)
        if size >= most:
            yield [keys.slice(start, len(held)), pa.array(held, pa.binary())]
            start, held, size = start + len(held), [], 0
    if held:
        yield [keys.slice(start, len(held)), pa.array(held, pa.binary())]
