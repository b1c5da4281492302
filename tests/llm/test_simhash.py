import random

import pytest
import xxhash

from listwright.llm import simhash
from listwright.llm.components import connected_components

from .odd import documents, odd_documents, rows_of


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)
    )


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_near(rows):
    """The component of each row: all pairs of fingerprints compared."""
    fps = [plain_fingerprint(t) for _, t in rows]
    close = [
        (i, j)
        for i in range(len(fps))
        for j in range(i)
        if bin(fps[i] ^ fps[j]).count("1") <= 2
    ]
    group = plain_components(range(len(fps)), close)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[group[i]] = min(ids.get(group[i], key), key)
    return [(rows[i][0], signed(fps[i]), ids.get(group[i])) for i in range(len(rows))]


def test_fingerprint():
    for text in ("", None, "a", "A b", "x y z w", "é É ß a b c " * 50):
        got = simhash.fingerprint(None if text is None else text.encode())
        assert got == signed(plain_fingerprint(text))


@pytest.mark.parametrize("cell_rows", [128, 2])
def test_near_duplicates(spark, cell_rows):
    random.seed(3)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(random.choices(words, k=120)) for _ in range(5)]
    near = [b.replace("w1 ", "W1 ", 1) + " w7" * random.randint(0, 2) for b in base * 4]
    docs = odd_documents(spark, [*base, *near])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = simhash.near_duplicates(docs, cell_rows=cell_rows)
    assert got.columns == ["doc_id", "fp", "component"]
    assert rows_of(got) == sorted(plain_near(rows), key=repr)


@pytest.mark.parametrize("cell_rows", [128, 1])
@pytest.mark.parametrize("max_bits", [1, 2])
def test_links(spark, cell_rows, max_bits):
    random.seed(max_bits)
    fps = {random.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for _ in range(4):
            for _ in range(random.randint(1, 3)):
                f ^= 1 << random.randrange(64)
            fps.add(f)
    fps |= {0, (1 << 64) - 1, 1, 3, 7}
    near = [
        (signed(a), signed(b)) for a in fps for b in fps
        if a < b and bin(a ^ b).count("1") <= max_bits
    ]
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    links = simhash.near_links(table, max_bits=max_bits, cell_rows=cell_rows)
    got = plain_components(map(signed, fps), map(tuple, links.collect()))
    assert got == plain_components(map(signed, fps), near)


def test_components(spark):
    random.seed(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 260)]
    links += [(random.randrange(400), random.randrange(400)) for _ in range(60)]
    links += [(7, 7), (5, 200), (None, 3)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = plain_components({n for link in real for n in link}, real)
    got = rows_of(connected_components(df))
    assert got == sorted(want.items(), key=repr)


def test_empty(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
