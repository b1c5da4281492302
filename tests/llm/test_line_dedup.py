import random

import pytest

from listwright.llm import line_dedup

from .odd import SENTENCE, documents, odd_documents, rows_of

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_chars=20, min_docs=3):
    rank = lambda doc: (doc is not None, doc or 0)
    docs = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            docs.setdefault(line.strip(SPACE).translate(LOWER), set()).add(doc)
    out = []
    for doc, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(LOWER)
            held = docs[key]
            shared = len(key) >= min_chars and len(held) >= min_docs
            if not shared or doc == max(held, key=rank):
                kept.append(line)
        out.append((doc, text, "\n".join(kept), len((text or "").split("\n")), len(kept)))
    return out


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
@pytest.mark.parametrize("batch", ["10000", "3"])
def test_lines(spark, partitions, batch):
    random.seed(int(partitions))
    lines = [f"shared line number {i} with some length" for i in range(12)] + ["short", ""]
    lines += ["  Padded and LONG enough line\t", "padded and long ENOUGH line", "é" * 19, "é" * 20]
    texts = ["\n".join(random.choices(lines, k=random.randint(0, 8))) for _ in range(120)]
    texts += [SENTENCE + f"\nown {i} line of this very text" for i in range(60)]
    docs = odd_documents(spark, texts).repartition(5)
    settings = {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": batch,
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        want = plain(rows)
        bitmaps = line_dedup.keep_bitmaps(docs)
        kept = line_dedup.apply_bitmaps(docs, bitmaps)
        assert kept.columns == docs.columns
        got = [(r.doc_id, r.text) for r in kept.collect()]
        assert sorted(got, key=repr) == sorted(
            ((w[0], None if w[1] is None else w[2]) for w in want), key=repr
        )
        counts = line_dedup.kept_digests(docs, bitmaps).select("doc_id", "n_lines", "n_dropped")
        assert rows_of(counts) == sorted(((w[0], w[3], w[3] - w[4]) for w in want), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty(spark):
    docs = documents(spark, [])
    assert line_dedup.kept_digests(docs, line_dedup.keep_bitmaps(docs)).count() == 0
