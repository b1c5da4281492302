import hashlib
import random
from collections import Counter

import pytest

from listwright.llm import suffix_runs

from .odd import SENTENCE, documents, odd_documents, rows_of


def plain(rows, length):
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for key, t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        rest = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def texts():
    random.seed(11)
    word = lambda: "".join(random.choices("abcdeé", k=random.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(30) for _ in range(4)]
    out = []
    for _ in range(40):
        parts = [prose(random.randint(0, 15))]
        for _ in range(random.randint(0, 3)):
            s = random.choice(shared)
            a, b = sorted(random.choices(range(len(s)), k=2))
            parts += [s[a:b], prose(random.randint(0, 6))]
        out.append(" ".join(parts))
    near = prose(80)
    for _ in range(8):
        at = random.randrange(len(near))
        out.append(near[:at] + "#" + near[at + random.randint(0, 1) :])
    return [*out, shared[0], shared[0] + shared[0], "ab" * 300, "xyz" * 100, "q" * 400]


@pytest.mark.parametrize("length,gram", [(40, 20), (60, 15), (40, 33)])
@pytest.mark.parametrize("small", [False, True])
def test_against_all_strings(spark, length, gram, small):
    odd = odd_documents(spark, texts()).filter("text IS NULL OR length(text) < 3000").repartition(4)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    sizes = {"range_suffixes": 50, "run_bytes": 3000} if small else {}
    removed = suffix_runs.removals(odd, length=length, gram=gram, **sizes)
    got = suffix_runs.kept_digests(odd, removed)
    assert rows_of(got) == plain(rows, length)


def test_production_length(spark):
    long = SENTENCE * 12
    docs = documents(spark, [(1, "x" + long), (2, "y" + long[:399]), (3, "z" + long[:400]),
                             (4, "".join(map(str, range(900)))), (5, long[7:407])])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = suffix_runs.kept_digests(docs, suffix_runs.removals(docs))
    assert rows_of(got) == plain(rows, suffix_runs.LENGTH)


def test_merge():
    random.seed(4)
    runs, every = [], []
    for r in range(7):
        run = sorted(
            suffix_runs.Suffix("".join(random.choices("ab", k=random.randint(1, 9))).encode(),
                               b"c" * random.randint(0, 3), r, i)
            for i in range(random.randint(0, 30))
        )
        runs.append([(*f, s) for f, s in zip(suffix_runs._front_coded(run), run)])
        every += run
    got = list(suffix_runs.merged(runs))
    words = [row[4].sorted_by for _, _, row in got]
    assert words == sorted(s.sorted_by for s in every)
    assert all(before == row[4].before for _, before, row in got)
    for (shared, *_), a, b in zip(got[1:], words, words[1:]):
        assert shared == suffix_runs.common_prefix(a, b)


def test_empty(spark):
    docs = documents(spark, [])
    assert suffix_runs.kept_digests(docs, suffix_runs.removals(docs)).count() == 0


def test_equal_suffixes_travel_once(spark):
    random.seed(3)
    line = "".join(random.choices("abcdef ", k=90))
    copies = [(i, line * 2) for i in range(60)]
    headed = [(100 + i, "".join(random.choices("xyz", k=i)) + line) for i in range(30)]
    ended = [(200 + i, line[i:] + "".join(random.choices("xyz", k=i % 3))) for i in range(50)]
    rows = [*copies, (7, copies[7][1]), *headed, *ended, (300, line[:40]), (301, line[50:])]
    docs = documents(spark, rows).coalesce(1)
    anchored = suffix_runs.repeated_anchors(docs, "text", "doc_id", 40, 20)
    texts = suffix_runs._identified(docs, "text", "doc_id").join(anchored, ["key", "version"])
    runs = suffix_runs.sorted_runs(texts.coalesce(1), 1, 40, 20)
    per_copy = texts.where("key = 7").first()["places"]
    # The copies of a text come to no more rows than one of them, the other texts to their own.
    others = texts.where("key >= 100").selectExpr("sum(size(places)) AS n").first().n
    assert runs.count() <= len(per_copy) + others
    for sizes in ({}, {"range_suffixes": 20, "run_bytes": 2000}):
        removed = suffix_runs.removals(docs, length=40, gram=20, **sizes)
        assert rows_of(suffix_runs.kept_digests(docs, removed)) == plain(rows, 40)


def test_ranges_fill_alike():
    random.seed(5)
    text = "".join(random.choices("abcdefgh ", k=200_000)).encode()
    places, _ = suffix_runs.anchors(text, 400, 120)
    found = suffix_runs.suffixes(text, places.tolist(), 0, 400, 120)
    ranges = Counter(int.from_bytes(s.sorted_by[:8], "big") * 10 >> 64 for s in found)
    assert len(ranges) == 10 and max(ranges.values()) < len(places) / 5
