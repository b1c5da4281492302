import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from listwright.llm import importance

from .odd import SENTENCE, documents, odd_documents, rows_of

BUCKETS = 512


def measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1
        for j in range(5)
    }
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def buckets(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    hashed = lambda s: zlib.crc32(s.encode()) % BUCKETS
    pairs = [BUCKETS + hashed(f"{a} {b}") for a, b in zip(words, words[1:])]
    return [hashed(w) for w in words] + pairs


def plain(rows, trusted, threshold):
    t, r = Counter(), Counter()
    for key, text in rows:
        for b in buckets(text):
            r[b] += 1
            t[b] += key in trusted
    weights = {}
    for b in r:
        side = [x for x in r if (x >= BUCKETS) == (b >= BUCKETS)]
        all_t, all_r = sum(t[x] for x in side), sum(r[x] for x in side)
        ratio = (t[b] + 1) / (all_t + BUCKETS) / ((r[b] + 1) / (all_r + BUCKETS))
        weights[b] = round(math.log(ratio) * 1e6) if all_t else 0
    out = []
    for key, text in rows:
        m = measures(text)
        grams = buckets(text)
        total = sum(weights[b] for b in grams)
        failed = m[0] < 10 or m[4] * 100 > m[0] * 20
        kept = not failed and total >= threshold * len(grams)
        out.append((key, *m, failed, len(grams), total, kept))
    return sorted(out, key=repr)


def test_rules(spark):
    texts = ["a b c d e " * 3 + "x", "\n".join([SENTENCE, SENTENCE, "own", "own", "", "  ", ""]),
             "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11", "#### $$ & < > |\n####"]
    docs = odd_documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    trusted = spark.createDataFrame([(49,), (49,), (0,), (None,), (12345,)], "doc_id bigint")
    got = importance.quality_rules(docs, trusted, buckets=BUCKETS, threshold=-20_000)
    assert rows_of(got) == plain(rows, {49, 0, 12345}, -20_000)
    assert {r.kept for r in got.collect()} == {True, False}
    none = importance.quality_rules(docs, trusted.filter("false"), buckets=BUCKETS)
    assert rows_of(none) == plain(rows, set(), 0)
    empty = documents(spark, [])
    assert importance.quality_rules(empty, trusted).count() == 0


def held_out(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:7], 16) % importance.FOLDS == 1


def plain_by_trusted(rows, trusted):
    """Like ``plain``, with the threshold that the trusted keys set which are held out."""
    step = lambda r: r[8] // (r[7] * 1000)
    judged = plain(rows, {k for k in trusted if not held_out(k)}, 0)
    steps = sorted(step(r) for r in judged if r[0] in trusted and held_out(r[0]) and not r[6])
    missed = len(steps) * importance.MISSED_PERCENT // 100
    return [(*r[:9], not r[6] and (not steps or step(r) >= steps[missed])) for r in judged]


def test_threshold_of_trusted(spark):
    rng = random.Random(8)
    good, bad = (["".join(rng.choices(letters, k=4)) for _ in range(300)]
                 for letters in ("abcdefg", "efghijk"))
    rows = [(i, " ".join(rng.choices(bad if i % 3 == 0 else good, k=40))) for i in range(900)]
    rows += [(None, rows[1][1]), (7, rows[7][1]), (9, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    keys = {i for i in range(900) if i % 3 and i % 2}
    trusted = spark.createDataFrame([(k,) for k in [*keys, None]], "doc_id bigint")
    got = rows_of(importance.quality_rules(docs, trusted, buckets=BUCKETS))
    assert got == sorted(plain_by_trusted(rows, keys), key=repr)
    kept = Counter(r[0] % 3 == 0 for r in got if r[-1] and r[0] is not None)
    assert kept[False] > 570 and kept[True] < 30
    # Only the held-out fold, or only the rest of it, is trusted.
    for some in (True, False):
        part = {k for k in keys if held_out(k) == some}
        few = spark.createDataFrame([(k,) for k in part], "doc_id bigint")
        got = rows_of(importance.quality_rules(docs, few, buckets=BUCKETS))
        assert got == sorted(plain_by_trusted(rows, part), key=repr)


def test_verdict_at_ten_times_the_load(spark):
    sf = os.environ.get("TEST_LOAD_DIR", "/root/testdata/sf0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    trusted = labels.filter("quality = 1 AND toxic = 0")
    bad = labels.filter("quality = 0").select("doc_id").distinct()
    shares = []
    # With a tenth of the buckets each holds ten times as many n-grams.
    for buckets in (importance.BUCKETS, importance.BUCKETS // 10):
        rows = importance.quality_rules(docs, trusted, buckets=buckets).filter("NOT base_failed")
        of_bad = rows.join(bad, "doc_id", "left_semi")
        shares.append(of_bad.agg(F.avg(F.expr("CAST(NOT kept AS int)"))).first()[0])
        of_good = rows.join(trusted.select("doc_id"), "doc_id", "left_semi")
        assert of_good.agg(F.avg(F.expr("CAST(kept AS int)"))).first()[0] > 0.95
    assert abs(shares[0] - shares[1]) < 0.05 and min(shares) > 0.9, shares


def test_native(spark):
    docs = odd_documents(spark)
    trusted = docs.select(F.col("doc_id"))
    weights = importance.gram_weights(docs, trusted)
    for got in (importance.quality_rules(docs, trusted), importance.scored(docs, weights)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
