import array
import random

import public_tokenizers
from tokenizers import Tokenizer

from listwright.llm import bpe

from .odd import documents, odd_documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_encode_and_decode(spark):
    random.seed(5)
    pieces = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "'s", "'ll", "<|endoftext|>",
              "!!", "漢", "🙂", "the", " of", "\r\n", "aaaaaaa", "x "]
    extra = ["".join(random.choices(pieces, k=random.randint(0, 40))) for _ in range(2000)]
    docs = odd_documents(spark, [*extra, "a" * 5000, " " * 300 + "x", "-" * 1000])
    library = Tokenizer.from_file(VOCABULARY)
    encoded = bpe.encode_texts(docs, VOCABULARY)
    got = [(r.doc_id, list(array.array("I", r.ids))) for r in encoded.collect()]
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = [(k, library.encode(t, add_special_tokens=False).ids) for k, t in texts]
    assert got == want
    decoded = bpe.decode_ids(encoded, VOCABULARY).collect()
    assert [(r.doc_id, r.text.decode()) for r in decoded] == texts


def test_digests(spark):
    import hashlib

    docs = odd_documents(spark)
    got = bpe.encoding_digests(docs, VOCABULARY).collect()
    encoded = bpe.encode_texts(docs, VOCABULARY).collect()
    assert [(r.doc_id, r.n_tokens, r.ids_sha256) for r in got] == [
        (r.doc_id, len(r.ids) // 4, hashlib.sha256(r.ids).hexdigest()) for r in encoded
    ]
    assert [r.decoded_sha256 for r in got] == [
        hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect()
    ]
    assert bpe.encoding_digests(documents(spark, []), VOCABULARY).count() == 0


def test_words_of_ascii():
    from listwright.llm import words

    random.seed(6)
    parts = ["a", "Z", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x00", "1", "'s", "'", "'ll",
             "'re", "'T", "_", "!", "?'d", "\r\n"]
    for _ in range(20_000):
        text = "".join(random.choices(parts, k=random.randint(0, 12)))
        assert words.find_words(text) == words._find_any(text), repr(text)
