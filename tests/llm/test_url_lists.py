import random

from listwright.llm import url_lists

from .odd import rows_of

URLS = [
    None, "", "no url", "http://", "https://A.B.example.COM/x/y?q#f", "http://b.example.com:80/x",
    "http://user@b.example.com/x", "ftp://other.org", "http://other.org/", "http://x..y/z",
    "http://b.example.com/x", "http://b.example.com/x",
]
COVERED = {
    "https://A.B.example.COM/x/y?q#f": {
        "a.b.example.com", "b.example.com", "example.com", "com", "a.b.example.com/x/y"},
    "http://b.example.com:80/x": {"b.example.com", "example.com", "com", "b.example.com/x"},
    "ftp://other.org": {"other.org", "org"},
    "http://other.org/": {"other.org", "org"},
}


def test_entries(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    got = {
        r.url: set(r.e) for r in df.select("url", url_lists.url_entries(df.url).alias("e")).collect()
    }
    assert all(got[u] == want for u, want in COVERED.items())
    assert all(got[u] == set() for u in URLS[:4])


def test_as_of(spark):
    random.seed(2)
    names = ["com", "example.com", "b.example.com", "b.example.com/x", "Other.org", "a.b.example.com"]
    log = [
        (random.choice(["block", "allow", "note"]), random.choice(names), random.random() < 0.6,
         random.randint(0, 12)) for _ in range(70)
    ] + [(None, "com", True, 1), ("block", None, True, 1), ("block", "com", True, None),
         ("block", "org", None, 3)]
    captures = [(i % 9, u, t) for i, u in enumerate(URLS) for t in [*range(-1, 14), None]]
    entries = spark.createDataFrame(log, "list string, entry string, added boolean, at int")
    table = spark.createDataFrame(captures, "page_id bigint, url string, fetched_at int")
    table = table.selectExpr("*", "'x' AS host", "1 AS row", "2 AS salt", "'e' AS entry")

    def state(name, entry, time):
        """Whether the last row at or before the time adds the entry."""
        rows = [(at, bool(added)) for n, e, added, at in log
                if n == name and e and e.lower() == entry and at is not None and at <= time]
        return bool(rows) and all(a for at, a in rows if at == max(rows)[0])

    urls = spark.createDataFrame([(u,) for u in URLS], "url string")
    rows = urls.select("url", url_lists.url_entries(urls.url).alias("e")).collect()
    covered = {r.url: list(r.e) for r in rows}
    want = []
    for key, url, time in captures:
        active = [
            (len(e), name == "allow", e, name)
            for e in covered[url] for name in ("block", "allow")
            if time is not None and state(name, e, time)
        ]
        best = max(active, default=(0, True, None, None))
        want.append((key, time, len(active), best[2], best[3], best[1]))
    got = url_lists.evaluate(table, entries, salts=3).drop("host")
    assert rows_of(got) == sorted(want, key=repr)
    assert {r.kept for r in got.collect()} == {True, False}
    assert url_lists.evaluate(table.filter("false"), entries).count() == 0
    assert all(r.kept for r in url_lists.evaluate(table, entries.filter("false")).collect())
