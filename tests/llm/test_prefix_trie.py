import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from listwright.llm import prefix_trie
from listwright.llm.oracle import ORACLE

from .odd import SENTENCE, rows_of


def conversations(spark, rows):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "turn", "role", "text", "key"]
    columns = list(zip(*((*row, "k") for row in rows))) or [[]] * 5
    return spark.createDataFrame(
        pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
    )


def held_against_sql(turns, **options):
    got = prefix_trie.prefix_nodes(prefix_trie.rebuilt(turns), **options)
    con = duckdb.connect()
    con.register("conversations", turns.select("conv_id", "turn", "role", "text").toArrow())
    want = con.sql(ORACLE["op13_prefix_trie"])
    rows = rows_of(got.select(*want.columns))
    assert rows == sorted(want.fetchall(), key=repr)
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_turns": 9, "piece_ids": 3}])
@pytest.mark.parametrize("partitions", [1, 7])
def test_nodes(spark, options, partitions):
    rng = random.Random(partitions)
    rows = [
        (conv, turn, rng.choice(["user", "bot", None]), rng.choice(["a", "b", "", None, "é" * 9]))
        for conv in range(90)
        for turn in range(rng.randint(1, 12))
        if conv % 5 or conv % 4
    ]
    rows += [(conv, t, "user", SENTENCE) for conv in range(200, 260) for t in range(3)]
    rows += [(7, None, "user", "early"), (8, 0, "bot", "tie"), (8, 0, "bot", "tie"), (8, 0, "a", "")]
    rows += [(None, 0, "user", "nobody"), (-3, 0, "u", "x"), (-5, 1, "u", "y"), (10**15, 1, None, None)]
    rows += [(501, t, "user", f"long {t}") for t in range(400)]
    held_against_sql(conversations(spark, rows).repartition(partitions), **options)


def test_empty(spark):
    assert held_against_sql(conversations(spark, [])) == []
    assert held_against_sql(conversations(spark, [(None, 1, "u", "t")])) == []
    # CRC-32 of "1" leaves no turn of it, and its family has no first conversation.
    alone = held_against_sql(conversations(spark, [(n, 0, "u", "t") for n in range(1, 5)]))
    assert alone[0][:2] == (1, 0)


@pytest.mark.parametrize("kind", ["dense", "sparse", "chain", "one"])
def test_double_array(kind):
    rng = random.Random(3)
    sequences = {
        "dense": {tuple(rng.choices(range(6), k=rng.randint(0, 6))) for _ in range(900)},
        "sparse": {tuple(rng.choices(range(0, 5000, 7), k=rng.randint(1, 3))) for _ in range(900)},
        "chain": {tuple(range(2000)), tuple(range(1000)), ()},
        "one": {(5,)},
    }[kind]
    trie = prefix_trie.DoubleArray([list(s) for s in sorted(sequences)])
    prefixes = {s[:n] for s in sequences for n in range(len(s) + 1)}
    assert (trie.check >= 0).sum() == len(prefixes) - 1
    seen = {}
    for prefix in prefixes:
        slot = np.array([0])
        for code in prefix:
            slot = trie.step(slot, np.array([code]))
            assert slot[0] > 0
        assert seen.setdefault(int(slot[0]), prefix) == prefix
        codes = range(8) if kind == "dense" else (0, 7, 10**7)
        for code in codes:
            there = trie.step(slot, np.array([code]))[0] >= 0
            assert there == ((*prefix, code) in prefixes)
