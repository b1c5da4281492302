"""Documents with every awkward case: nulls, empties, repeats, long texts, clashing columns."""

from __future__ import annotations

import pyarrow as pa

SENTENCE = "The quick brown fox jumps over the lazy dog near the old river bank at noon today. "


def odd_documents(spark, extra=()):
    texts = [
        None, "", " ", "\n\n", "a", "one two", "\x0b\x0c\r\t x\ty\n",
        SENTENCE, SENTENCE, SENTENCE.upper(), SENTENCE * 300, "word " * 20_000,
        "naïve Straße ΑΒΓ 漢字 🙂 Éa\n" * 3, "<|endoftext|>mid<|endoftext|> end  two   spaces \n x",
        *extra,
    ]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)]
    rows += [rows[7], (None, SENTENCE), (None, None)]
    return documents(spark, rows)


def documents(spark, rows):
    table = pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()),
        "text": pa.array([r[1] for r in rows], pa.string()),
        "key": pa.array(["k"] * len(rows), pa.string()),
        "fp": pa.array([None] * len(rows), pa.int32()),
        "cell": pa.array([1] * len(rows), pa.int32()),
        "pos": pa.array([1] * len(rows), pa.int32()),
        "count": pa.array([1] * len(rows), pa.int32()),
    })
    return spark.createDataFrame(table)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
