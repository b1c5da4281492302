import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from listwright.llm import repair
from listwright.storage import fresh_path

from .odd import documents, odd_documents, rows_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def expected(docs):
    library = Tokenizer.from_file(VOCABULARY)
    rows = sorted(
        ((r.doc_id, r.text) for r in docs.collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()),
    )
    start, out = 0, []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_ids", [4_000_000, 50])
def test_shards(spark, block_ids):
    docs = odd_documents(spark)
    path = fresh_path(spark, "shards")
    repair.write_shards(docs, path, VOCABULARY, block_ids=block_ids)
    assert rows_of(repair.read_documents(spark, path)) == expected(docs)


def test_empty(spark):
    path = fresh_path(spark, "shards")
    repair.write_shards(documents(spark, []), path, VOCABULARY)
    assert repair.read_documents(spark, path).count() == 0


@pytest.mark.parametrize("kind", ["runs", "random", "text", "short", "none"])
def test_compress(kind):
    rng = np.random.default_rng(4)
    ids = {
        "runs": np.repeat(rng.integers(0, 5, 300), rng.integers(1, 40, 300)),
        "random": rng.integers(0, 50_000, 5000),
        "text": rng.zipf(1.3, 60_000) % 5000,
        "short": np.array([7]),
        "none": np.array([], np.int64),
    }[kind].astype(np.uint32)
    grammar = repair.compress(ids, 50_257)
    expander = repair.Expander(grammar)
    assert (expander.ids(0, len(ids)) == ids).all()
    for start in range(0, len(ids), 97):
        assert (expander.ids(start, start + 5) == ids[start : start + 5]).all()
    assert kind not in ("runs", "text") or len(grammar.symbols) < 0.75 * len(ids)


def test_goes_on_to_the_end():
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 3000, rng.integers(2, 6)) for _ in range(4000)]
    ids = np.concatenate([words[i] for i in rng.zipf(1.2, 150_000) % 4000]).astype(np.uint32)
    grammar = repair.compress(ids, 50_257)
    assert len(grammar.lefts) > 2048
    _, counts = np.unique(repair._pair_codes(grammar.symbols.astype(np.uint32)), return_counts=True)
    # What is left overlaps itself, so that only every second occurrence can be replaced.
    assert (counts >= 2 * repair.LEAST_COUNT).sum() == 0 or len(grammar.lefts) == 65_536 - 50_257


def test_encoder():
    library, encoder = Tokenizer.from_file(VOCABULARY), repair.Encoder(VOCABULARY)
    for text in ["", " ", "a<|endoftext|>", "<|endoftext|><|endoftext|> b", "x" * 5000 + " " * 900 + "y"]:
        ids = [i for part in encoder.encode(text) for i in part.tolist()]
        assert ids == library.encode(text, add_special_tokens=False).ids
