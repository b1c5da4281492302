"""Duplicates, positions, sinks and streams, against brute force on small fixtures."""

import random
import re
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listwright import storage, streaming
from listwright.operators import dedupe, emails, joins, ordering, stats
from listwright.operators.file_names import conflict_suffix
from listwright.plans.consolidate import consolidate, stats_total
from listwright.sinks import write_blocks, write_chunks, write_kinds, write_lines, write_table
from listwright.streaming import known

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
LINES = "source string, priority int, file string, line_no long, original string, nick string"


def two_sources(spark):
    rows = [("test1", n) for n in ("user1", "user2", "user3", "common")]
    rows += [("test2", n) for n in ("user4", "user5", "common", "user3")]
    return spark.createDataFrame(
        [(s, int(s[-1]), "f", i, n.title(), n) for i, (s, n) in enumerate(rows)], LINES
    )


def skewed(rng, n=3000):
    """A third of all rows is one value, in one source and one file."""
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        priority = 2 if hot else rng.randrange(5)
        file = "hot" if hot else f"f{rng.randrange(6)}"
        nick = "hot" if hot else f"n{rng.randrange(400)}"
        rows.append((f"s{priority}", priority, file, i, nick.upper() + str(i), nick))
    return rows


def first_seen(rows):
    best = {}
    for row in rows:
        place = (row[1], row[2], row[3])
        if row[5] not in best or place < best[row[5]][0]:
            best[row[5]] = (place, row[4])
    return best


def text_of(path):
    return "".join(p.read_text() for p in sorted(Path(path).rglob("part-*")))


def test_priority_keeps_the_earlier_source(spark):
    kept = dedupe.dedupe_priority(two_sources(spark), keep=("source",)).collect()
    assert len(kept) == 6
    sources = {r.nick: r.source for r in kept}
    assert sources["user3"] == sources["common"] == "test1"
    assert dedupe.dedupe_unordered(two_sources(spark)).count() == 6


@few
@given(st.integers(0, 10**6))
def test_dedupe_is_the_minimum_of_each_group(spark, seed):
    rows = skewed(random.Random(seed), 600)
    df = spark.createDataFrame(rows, LINES).repartition(5)
    best = first_seen(rows)
    kept = dedupe.dedupe_priority(df, keep=("original",)).collect()
    got = {r.nick: ((r.priority, r.file, r.line_no), r.original) for r in kept}
    assert len(kept) == len(got) and got == best
    names = df.select("nick").union(spark.createDataFrame([("lonely",)], "nick string")).distinct()
    originals = {r.nick: r.original for r in joins.with_original(names, df).collect()}
    assert originals == {**{k: v[1] for k, v in best.items()}, "lonely": "lonely"}
    alone = spark.createDataFrame([("x", None, "f", 1, "LONELY", "lonely")], LINES)
    forms = {r.nick: r.original for r in joins.original_forms(df.union(alone)).collect()}
    assert forms == originals


def test_dedupe_lines(spark):
    rows = [("f", 0, "a"), ("f", 1, "A"), ("f", 2, "a "), ("g", 0, ""), ("g", 1, ""), ("g", 2, "a")]
    df = spark.createDataFrame(rows, "file string, line_no long, value string")
    kept = dedupe.dedupe_lines(df).orderBy("file", "line_no").collect()
    assert [r.value for r in kept] == ["a", "A", "a ", ""]
    assert sorted(r.value for r in dedupe.dedupe_lines(df, trim=True).collect()) == ["A", "a"]


def test_incremental_new(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("b",)], "nick string")
    batch = spark.createDataFrame([("b",), ("c",), ("c",)], "nick string")
    assert [r.nick for r in dedupe.incremental_new(batch, seen).collect()] == ["c"]
    assert sorted(r.nick for r in dedupe.incremental_new(batch, seen.limit(0)).collect()) == ["b", "c"]


def test_global_ordinal(spark):
    rows = skewed(random.Random(3))
    df = spark.createDataFrame(rows, LINES).repartition(7)
    order = ("priority", "file", "line_no")
    numbered = ordering.global_ordinal(df, order, total="n").orderBy("ord").collect()
    assert [r.ord for r in numbered] == list(range(len(rows)))
    wanted = sorted((r[1], r[2], r[3]) for r in rows)
    assert [(r.priority, r.file, r.line_no) for r in numbered] == wanted
    assert {r.n for r in numbered} == {len(rows)}
    plan = ordering.global_ordinal(df, order)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_group_ordinal_of_a_hot_group(spark):
    rows = skewed(random.Random(4))
    df = spark.createDataFrame(rows, LINES)
    placed = ordering.group_ordinal(df, ("nick",), ("line_no",)).collect()
    members = {}
    for row in sorted(rows, key=lambda r: r[3]):
        members.setdefault(row[5], []).append(row[3])
    assert len(placed) == len(rows)
    assert all(members[r.nick][r.ord_in_group] == r.line_no for r in placed)


def test_group_ordinal_over_slices(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SLICE_ROWS", 7)
    df = spark.range(100).select((F.col("id") % 3 == 0).alias("g"), "id")
    placed = ordering.group_ordinal(df, ("g",), ("id",)).collect()
    assert len(placed) == 100
    wanted = {i: n for g in (0, 1) for n, i in enumerate(x for x in range(100) if (x % 3 == 0) == g)}
    assert {r.id: r.ord_in_group for r in placed} == wanted


def numbered_list(spark, n):
    df = spark.range(n).select(F.format_string("v%03d", "id").alias("nick"))
    return ordering.global_ordinal(df, ("nick",), total="total")


@pytest.mark.parametrize("n", [0, 1, 4, 5, 9])
def test_chunks(spark, tmp_path, n):
    chunked = ordering.assign_chunks(numbered_list(spark, n), 4)
    path = str(tmp_path / "out")
    write_chunks(chunked, path, "nick")
    found = sorted(Path(path).glob("chunk=*"), key=lambda p: int(p.name[6:]))
    assert len(found) == -(-n // 4)
    lines = []
    for number, folder in enumerate(found):
        (part,) = folder.glob("part-*")
        content = part.read_text().splitlines()
        assert len(content) == 4 or number == len(found) - 1
        lines += content
    assert lines == [f"v{i:03d}" for i in range(n)]


def test_comma_rules(spark):
    df = spark.createDataFrame([("a",), ("b ",), ("c,,",)], "nick string")
    numbered = ordering.global_ordinal(df, ("nick",), total="n")
    for per_file, wanted in ((False, ["a,", "b,", "c"]), (True, ["a,", "b ", "c"])):
        split = ordering.with_commas(numbered, "nick", "n", 2, per_file).orderBy("ord").collect()
        assert [r.line for r in split] == wanted
        assert [r.chunk_file for r in split] == ["chunk_001.txt"] * 2 + ["chunk_002.txt"]


def test_sample_and_blocks(spark, tmp_path):
    numbered = numbered_list(spark, 5)
    assert ordering.sample_chunks(numbered, 1, 2).count() == 2
    assert ordering.sample_chunks(numbered, 9, 2).count() == 5
    write_blocks(numbered, str(tmp_path / "b"), rows=2)
    assert text_of(tmp_path / "b") == "v000,v001,\nv002,v003,\nv004,\n"


def test_text_input_of_blocks_is_trimmed(spark):
    df = spark.createDataFrame([(0, " a "), (1, " "), (2, "b")], "line_no int, value string")
    numbered = ordering.global_ordinal(ordering.trimmed_values(df, "value"), ("line_no",))
    assert [r.line for r in ordering.join_blocks(numbered, "value").collect()] == ["a,b,"]


def test_line_and_kind_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "abcdefg"), (1, "u@x.org"), (3, "abc")], "i int, value string")
    write_lines(df, str(tmp_path / "l"), "value", order=("i",))
    assert text_of(tmp_path / "l") == "u@x.org\nabcdefg\nabc\n"
    write_kinds(df, str(tmp_path / "k"))
    kinds = {k: sorted(text_of(tmp_path / "k" / f"kind={k}").split()) for k in ("email", "name", "token")}
    assert kinds == {"email": ["u@x.org"], "name": ["abc", "abcdefg"], "token": ["abcdefg"]}


def test_existing_output_is_kept_unless_forced(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3
    write_table(spark.range(5), path, force=True)
    assert spark.read.parquet(path).count() == 5


def test_conflict_suffix(spark):
    rng = random.Random(5)
    names = ["x.txt", "x_1.txt", "x_2.txt", "x_4.txt", "x", "x_1", "x_01.txt", "y.md", "x_1_1.txt"]
    files = [(f"p{i:03d}", rng.choice(["a", "b"]), rng.choice(names)) for i in range(60)]
    df = spark.createDataFrame(files, "path string, category string, name string")
    got = {r.path: r.target for r in conflict_suffix(df).collect()}
    for category in ("a", "b"):
        mine = sorted(f for f in files if f[1] == category)
        real, used, count = {f[2] for f in mine}, {}, {}
        for path, _, name in mine:
            count[name] = count.get(name, 0) + 1
            if count[name] == 1:
                assert got[path] == name
                continue
            stem, dot, ext = name.partition(".")
            number = used.get(name, 0) + 1
            while f"{stem}_{number}{dot}{ext}" in real:
                number += 1
            used[name] = number
            assert got[path] == f"{stem}_{number}{dot}{ext}"
        assert len({got[f[0]] for f in mine}) == len(mine)


def test_conflict_suffix_without_clash(spark):
    df = spark.createDataFrame([("p1", "c", "x.txt"), ("p2", "c", "x.txt"), ("p3", "d", "x.txt")],
                               "path string, category string, name string")
    got = {r.path: r.target for r in conflict_suffix(df).collect()}
    assert got == {"p1": "x.txt", "p2": "x_1.txt", "p3": "x.txt"}


def test_registry_side(spark):
    df = spark.createDataFrame(skewed(random.Random(6), 500), LINES)
    df = df.withColumn("tags", F.create_map(F.lit("k"), "nick"))
    slugs = spark.createDataFrame([(f"s{i}", i * 10) for i in (0, 2, 3, 9)], "source string, x int")
    joined = df.join(storage.registry_side(slugs), "source")
    assert joined.count() == df.where("source in ('s0', 's2', 's3')").count()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="more than 3 rows"):
        df.join(storage.registry_side(slugs, most=3), "source").count()


def test_group_ordinal_with_null_groups(spark):
    rows = [(None, 3), (None, 1), ("a", 2), ("a", 0)]
    df = spark.createDataFrame(rows, "g string, i int")
    placed = ordering.group_ordinal(df, ("g",), ("i",)).collect()
    assert {(r.g, r.i): r.ord_in_group for r in placed} == {
        (None, 1): 0, (None, 3): 1, ("a", 0): 0, ("a", 2): 1,
    }


def test_conflict_suffix_with_null_category_and_long_numbers(spark):
    names = ["x.txt", "x.txt", "x_1.txt", "y_12345678901.txt", "y.txt", "y.txt"]
    files = [(f"p{i}", None, n) for i, n in enumerate(names)]
    df = spark.createDataFrame(files, "path string, category string, name string")
    got = [r.target for r in conflict_suffix(df).orderBy("path").collect()]
    assert got == ["x.txt", "x_2.txt", "x_1.txt", "y_12345678901.txt", "y.txt", "y_1.txt"]


def test_consolidate_and_stats(spark):
    lines = two_sources(spark).drop("nick", "priority")
    registry = spark.createDataFrame([("test2", 0), ("test1", 1), ("test3", 2)], "slug string, priority int")
    rows = consolidate(lines, registry, keep_original=True).collect()
    assert {r.nick: (r.priority, r.original) for r in rows}["common"] == (0, "Common")
    total = stats_total(lines, registry).first()
    assert (total.n_normalized, total.n_deduped, total.duplicate_rate) == (8, 6, 25.0)
    new = stats.new_uniques(consolidate(lines, registry), registry).orderBy("priority").collect()
    assert [(r.slug, r.n_new, r.n_total) for r in new] == [("test2", 4, 4), ("test1", 2, 6), ("test3", 0, 6)]
    assert stats_total(lines.limit(0), registry).first().duplicate_rate == 0.0


def test_source_differences(spark):
    lines = two_sources(spark)
    registry = spark.createDataFrame([("test1", 0), ("test9", 1)], "slug string, priority int")
    assert [r.source for r in joins.stale_sources(lines, registry).collect()] == ["test2"]
    assert [r.slug for r in joins.missing_sources(registry, lines).collect()] == ["test9"]
    assert joins.registered_only(lines, registry).count() == 4


def test_export_stats(spark):
    names = spark.createDataFrame([("a",), ("b",), ("b",)], "nick string")
    mails = spark.createDataFrame([("a@x", "a", "x"), ("c@x", "c", "x"), ("c@y", "c", "y")],
                                  "email string, local_part string, domain string")
    assert tuple(emails.export_stats(names, mails).first()) == (3, 2, 2, 3)
    assert sorted(r.nick for r in emails.combine_names(names, mails).collect()) == ["a", "b", "c"]


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, content in enumerate(("a\nb\n", "b\nc\n", "C!\na\n")):
        (folder / f"{i}.txt").write_text(content)
    stream = streaming.stream_lines(spark, str(folder), files_per_batch=1)
    found = streaming.run_available(streaming.stream_dedupe(stream))
    assert sorted(r.value for r in found.collect()) == ["C!", "a", "b", "c"]
    names = streaming.stream_dedupe(streaming.stream_normalize(stream), "nick")
    assert sorted(r.nick for r in streaming.run_available(names).collect()) == ["a", "b", "c"]
    table = str(tmp_path / "known")
    streaming.append_new(stream, table)
    (folder / "3.txt").write_text("d\na\n")
    streaming.append_new(stream, table)
    known = spark.read.parquet(table)
    assert sorted(r.value for r in known.collect()) == ["C!", "a", "b", "c", "d"]
    assert known.columns == ["value", "bucket"]


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "0.txt").write_text("a\nb\n")
    stream = streaming.stream_dedupe(streaming.stream_lines(spark, str(folder)))
    assert streaming.run_available(stream, out).count() == 2
    (folder / "1.txt").write_text("b\nc\n")
    assert sorted(r.value for r in streaming.run_available(stream, out).collect()) == ["a", "b", "c"]


def test_a_batch_opens_few_folders(spark, tmp_path):
    table = str(tmp_path / "known")
    for start, stop in ((0, 300_000), (300_000, 2_000_000)):
        values = spark.range(start, stop).select(F.concat(F.lit("value "), F.col("id")).alias("value"))
        streaming.write_known(values, table)
    folders = spark.read.parquet(table).select("bucket").distinct().count()
    # The first generation holds 640,000 values, so the second write went into a larger one.
    assert folders == 64 + 256
    new = spark.range(1000).select(F.concat(F.lit("new "), F.col("id")).alias("value"))
    opened = known.possible_buckets(new, table)
    assert len(opened) < 0.2 * folders
    old = spark.range(7).select(F.concat(F.lit("value "), F.col("id") * 250_001).alias("value"))
    assert 1 <= len(known.possible_buckets(old, table)) <= 16
    known.add_unknown(new.union(old).union(old), table)
    stored = spark.read.parquet(table)
    assert stored.count() == stored.select("value").distinct().count() == 2_001_000
    known.add_unknown(new.union(old), table)
    assert spark.read.parquet(table).count() == 2_001_000


def test_marks_without_values_do_no_harm(spark, tmp_path):
    table = str(tmp_path / "known")
    values = spark.createDataFrame([("a",), (None,), ("b",)], "value string")
    known.add_unknown(values, table)
    # As after a batch that failed once its marks were written.
    marks = spark.read.parquet(f"{table}-marks").collect()
    lost = spark.createDataFrame([("c",)], "value string")
    known.write_known(lost, str(tmp_path / "other"))
    spark.read.parquet(str(tmp_path / "other-marks")).write.mode("append").parquet(f"{table}-marks")
    assert spark.read.parquet(f"{table}-marks").count() > len(marks)
    known.add_unknown(lost.union(values), table)
    assert sorted(r.value for r in spark.read.parquet(table).collect()) == ["a", "b", "c"]


def _comparisons(spark, table):
    files = spark.read.parquet(f"{table}-marks").select("_metadata.file_name").distinct().collect()
    return len({re.sub(r"^part-\d+-", "", r.file_name)[:36] for r in files})


def _arriving(folder, batches):
    folder.mkdir()
    for i in range(batches):
        (folder / f"{i}.txt").write_text(f"a\nb{i}\nb{i // 2}\n{'c' * i}\n")
    return {"a", "", *(f"b{i}" for i in range(batches)), *("c" * i for i in range(batches))}


def test_batches_of_a_stream_are_compared_together(spark, tmp_path, monkeypatch):
    expected = _arriving(tmp_path / "in", 8)
    stream = streaming.stream_lines(spark, str(tmp_path / "in"), files_per_batch=1)
    for fewest, most in ((1000, 2), (3, 4)):
        monkeypatch.setattr(known.Arrivals, "FEWEST", fewest)
        table = str(tmp_path / f"known-{fewest}")
        streaming.write_known(spark.createDataFrame([("a",), ("old",)], "value string"), table)
        streaming.append_new(stream, table)
        values = [r.value for r in spark.read.parquet(table).collect()]
        assert sorted(values) == sorted(expected | {"old"})
        # The first one is that of the values known before.
        assert _comparisons(spark, table) == most
        assert known.Arrivals(spark, table, stream.select("value").schema).rows == 0


def test_a_failed_stream_leaves_no_value_out(spark, tmp_path, monkeypatch):
    expected = _arriving(tmp_path / "in", 4)
    stream = streaming.stream_lines(spark, str(tmp_path / "in"), files_per_batch=1)
    table = str(tmp_path / "known")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(known, "add_unknown", fail)
        with pytest.raises(RuntimeError, match="lost"):
            streaming.append_new(stream, table)
    # All batches are committed by now, so none arrives again.
    streaming.append_new(stream, table)
    assert sorted(r.value for r in spark.read.parquet(table).collect()) == sorted(expected)
    # As after a stream that failed before the files of its batches were cleared.
    again = spark.createDataFrame([("a",), (None,), ("new",), ("new",)], "value string")
    known.Arrivals(spark, table, again.schema).take(again)
    streaming.append_new(stream, table)
    stored = [r.value for r in spark.read.parquet(table).collect()]
    assert sorted(stored) == sorted(expected | {"new"})


def test_very_many_values_open_all_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(known, "MANY", 0)
    table = str(tmp_path / "known")
    old = spark.range(100).select(F.concat(F.lit("value "), F.col("id")).alias("value"))
    streaming.write_known(old, table)
    folders = {r.bucket for r in spark.read.parquet(table).select("bucket").distinct().collect()}
    assert set(known.possible_buckets(old.limit(1), table)) == folders
    known.add_unknown(old.union(old.selectExpr("concat('new ', value)")), table)
    stored = spark.read.parquet(table)
    assert stored.count() == stored.select("value").distinct().count() == 200
