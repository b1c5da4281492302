import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from listwright.llm import alignment
from listwright.llm.words import byte_alphabet

from .odd import SENTENCE, documents, odd_documents, rows_of

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def tokens(text, library, pieces, to_byte):
    """Ids and bytes of the tokens of both sides, or None."""
    if not text:
        return None
    encoded = library.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(to_byte[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
    b = []
    for i in pieces.encode(text):
        name = pieces.id_to_piece(i)
        raw = bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("\u2581", " ").encode()
        b.append((i, raw))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else None


def ranges(side):
    at, out = 0, []
    for number, raw in side:
        out.append((number, at, at + len(raw)))
        at += len(raw)
    return out


def plain(rows):
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    to_byte = {c: b for b, c in byte_alphabet().items()}
    found, counts = [], Counter()
    for _, text in rows:
        both = tokens(text, library, pieces, to_byte)
        if both is None:
            found.append(None)
            continue
        a, b = map(ranges, both)
        links, first = [], 0
        for i, start, end in a:
            while b[first][2] <= start:
                first += 1
            later = first
            while later < len(b) and b[later][1] < end:
                links.append((i, b[later][0]))
                later += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, used = [], [0, 0]
        for cut in cuts:
            sides = []
            for n, side in enumerate((a, b)):
                start = used[n]
                while used[n] < len(side) and side[used[n]][2] <= cut:
                    used[n] += 1
                sides.append(",".join(str(i) for i, *_ in side[start : used[n]]))
            groups.append("|".join(sides))
        found.append((a, b, links, groups))
        counts.update(links)
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for (key, _), row in zip(rows, found):
        if row is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = row
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((
            key, len(a), len(b), len(groups), len(links),
            sum(counts[pair] == best[pair[1]] for pair in links),
            sum(counts[pair] for pair in links), digest,
        ))
    return sorted(out, key=repr), sorted((*p, n, n == best[p[1]]) for p, n in counts.items())


ODD = [
    "a\u2581b", "\u2581", "<s> x </s>", "<0x41> byte", "<unk>", "tab\tand  two\r\nlines", "\x00nul",
    "  leading", "trailing  ", " " * 700 + "x", "\n" * 3000, "e\u0301 \u00a0 \ufeff", "x" * 9000,
    "\U0001f468\u200d\U0001f469 \u0e2a\u0e27\u0e31\u0e2a", "<|endoftext|><|endoftext|>",
]


@pytest.mark.parametrize("options", [{}, {"group_chars": 60, "block_links": 40}])
@pytest.mark.parametrize("partitions", [1, 6])
def test_alignment(spark, options, partitions):
    docs = odd_documents(spark, [*ODD, *(SENTENCE[i:] for i in range(0, 60, 7))])
    want, want_pairs = plain([(r.doc_id, r.text) for r in docs.collect()])
    got, pairs = alignment.aligned(docs.repartition(partitions), BYTES, PIECES, **options)
    assert rows_of(got) == want
    assert sorted(map(tuple, pairs.select("a", "b", "total", "best").collect())) == want_pairs


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want, _ = plain([(r.doc_id, r.text) for r in docs.limit(60).collect()])
    got, _ = alignment.aligned(docs.limit(60), BYTES, PIECES, group_chars=5000, block_links=9000)
    assert rows_of(got) == want


def test_empty(spark):
    assert rows_of(alignment.aligned(documents(spark, []), BYTES, PIECES)[0]) == []
    nothing = documents(spark, [(1, None), (2, ""), (None, None)])
    got = rows_of(alignment.aligned(nothing, BYTES, PIECES)[0])
    assert got == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]
