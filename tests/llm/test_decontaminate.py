import random
import re

import pytest

from listwright.llm import decontaminate

from .odd import documents, odd_documents, rows_of


def plain_text(text):
    text = (text or "").lower()
    return re.sub(rb"(?:[\x00-\x7f](?<![a-z0-9]))+", b" ", text.encode()).strip(b" ")


def least_edits(segment, text):
    """The edits of the best place of a segment in a text, by the whole table."""
    row = list(range(len(segment) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, s in enumerate(segment):
            new.append(min(row[i] + (s != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def plain(rows, items):
    out = []
    for key, text in rows:
        body = plain_text(text)
        for item, t in items:
            n = plain_text(t)
            if len(n) < 30:
                continue
            starts = [*range(0, max(1, len(n) - 100), 50), *([len(n) - 100] if len(n) > 100 else [])]
            found = []
            for s in starts:
                part = n[s : s + 100]
                edits = least_edits(part, body)
                if edits <= min(int(len(part) * 0.1), (len(part) - 8) // 8):
                    found.append(edits)
            if found:
                out.append((key, item, len(found), min(found)))
    return sorted(out, key=repr)


def edited(text, n):
    for _ in range(n):
        at = random.randrange(len(text))
        text = random.choice([
            text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1 :]
        ])
    return text


@pytest.fixture(scope="module")
def leaks(spark):
    random.seed(8)
    words = [f"{a}{b}{c}" for a in ("th", "st", "br") for b in "aeiou" for c in ("ne", "lt", "m")]
    prose = lambda n: " ".join(random.choices(words, k=n))
    items = [(i, prose(n).capitalize() + ".") for i, n in enumerate([6, 9, 15, 30, 40, 25])]
    items += [(6, None), (7, ""), (8, "too short to tell"), (9, items[3][1]), (10, "Größe " * 9)]
    texts = [prose(60) for _ in range(6)]
    for _, t in items[:6]:
        for n in (0, 2, 6, 9, 12, 25):
            texts.append(f"{prose(12)}, {edited(t, n)} {prose(9)}")
        texts += [t.upper(), t[: len(t) // 2], "  ".join(t.split()).replace(".", " !\n")]
    texts += ["GRÖSSE " * 9, "größe " * 9, items[3][1][:60], items[3][1][60:]]
    docs = odd_documents(spark, texts).filter("text IS NULL OR length(text) < 2000")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    return docs, table, plain([(r.doc_id, r.text) for r in docs.collect()], items)


@pytest.mark.parametrize("block", [4_000_000, 150])
def test_against_whole_tables(leaks, block):
    docs, items, want = leaks
    got = decontaminate.contaminated(docs, items, block_bytes=block)
    assert rows_of(got.drop("end")) == want
    assert len(want) > 30
    kept = decontaminate.clean(docs, items, block_bytes=block)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - len(
        [r for r in docs.collect() if plain([(0, r.text)], [tuple(i) for i in items.collect()])]
    )


def test_long_texts_are_cut_without_loss(leaks, monkeypatch):
    docs, items, want = leaks
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 90)
    index = decontaminate.build_index([decontaminate.normalised(r.text) for r in items.collect()])
    names = [r.item_id for r in items.collect()]
    rows = docs.collect()
    met = decontaminate._in_batch([r.text for r in rows], index)
    got = {(repr(rows[m[0]].doc_id), names[m[1]], m[3]) for m in met}
    assert got == {(repr(w[0]), w[1], w[3]) for w in want}


def test_empty(spark, leaks):
    docs, items, _ = leaks
    assert decontaminate.contaminated(documents(spark, []), items).count() == 0
    assert decontaminate.contaminated(docs, items.filter("false")).count() == 0
    assert decontaminate.clean(docs, items.filter("false")).count() == docs.count()


def test_excerpts_at_every_offset(spark):
    random.seed(3)
    letters = "abcdefghijklmnoprstuvwy"
    item = " ".join("".join(random.choices(letters, k=random.randint(2, 9))) for _ in range(45))
    ends = [at for at in range(len(item) - 89) if " " not in (item[at], item[at + 89])]
    assert len(item) > 240 and len(ends) > 90
    texts = [f"{'zq xj ' * 9}{item[at : at + 90]}{' qz jx' * 9}" for at in ends]
    docs = documents(spark, list(enumerate(texts)))
    items = spark.createDataFrame([(0, item)], "item_id bigint, text string")
    shift = decontaminate.SHIFT
    assert decontaminate.contaminated(docs, items, shift=shift).count() == len(texts)
    assert decontaminate.clean(docs, items, shift=shift).count() == 0
    # What has a whole counted segment is reported by these alone.
    index = decontaminate.build_index([item.encode()], shift=shift)
    for row, _, n, edits, _ in decontaminate._in_batch(texts, index):
        whole = plain([(0, texts[row])], [(0, item)])
        assert (n, edits) == (whole[0][2:] if whole else (0, edits)) and edits <= 10


def test_segments_of_all_pieces_are_counted(monkeypatch):
    random.seed(5)
    item = " ".join("".join(random.choices("abcdefghiklmnoprstuvwy", k=6)) for _ in range(60))
    text = f"{item[:200]}{' zqxj' * 400} {item[200:]}{' qzjx' * 400} {item[100:300]}"
    index = decontaminate.build_index([item.encode()])
    ((_, _, n, edits, end),) = decontaminate._in_batch([text], index)
    assert n == len(index.items) and edits == 0
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 700)
    assert decontaminate._in_batch([text], index) == [(0, 0, n, edits, end)]
