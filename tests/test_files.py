import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from listwright import sinks
from listwright.operators import dedupe, ordering, stats
from listwright.operators.joins import files_by_source
from listwright.sources import files, manifest
from listwright.sources import lines as sources
from listwright.sources.registry import check_registry, source_registry


def write(root, **named):
    for name, content in named.items():
        path = root / name.replace("__", "/").replace("_dot_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())


def values(df):
    return [r.original for r in df.orderBy("file", "block", "line_no").collect()]


def test_text_scan(spark, tmp_path):
    write(tmp_path, a_dot_txt=b" one \n\n\xfftwo\r\nthree\n", b_dot_txt="four", c_dot_csv="no")
    scanned = sources.scan_lines(spark, str(tmp_path), "s", pattern="*.txt")
    assert values(scanned) == ["one", "two", "three", "four"]
    raw = sources.scan_raw_lines(spark, str(tmp_path), "s", pattern="*.txt")
    assert raw.count() == 5


def test_text_order_over_splits(spark, tmp_path):
    wanted = [f"line {i}" for i in range(5000)]
    write(tmp_path, big_dot_txt="\n".join(wanted) + "\n", small_dot_txt="x\n" * 10)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scanned = sources.scan_lines(spark, str(tmp_path), "s").where("original like 'line%'")
        assert scanned.select("block").distinct().count() > 3
        assert values(scanned) == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_scan(spark, tmp_path):
    write(
        tmp_path,
        a_dot_csv='id,username,note\n1,Ann,x\n2,Bob\n3,"C, d","say ""hi"""\n4,Eve,a,b\n5,Eve,a,b,c\n',
        b_dot_csv="username\nZoe\n",
    )
    scanned = files.scan_delimited(spark, str(tmp_path), "s", same_header=False)
    assert values(scanned) == ["Ann", "Bob", "C, d", "Zoe"]
    bad = files.quarantine_delimited(spark, str(tmp_path), "s", same_header=False)
    assert sorted(r.raw for r in bad.collect()) == ["4,Eve,a,b", "5,Eve,a,b,c"]
    assert bad.columns == list(files.QUARANTINE_COLUMNS)


def test_csv_column_names(spark, tmp_path):
    write(tmp_path, a_dot_csv="\ufeffname,x\nAnn,1\n", odd__b_dot_csv="a.`b,c\nBob,1\n")
    assert values(files.scan_delimited(spark, str(tmp_path / "a.csv"), "s")) == ["Ann"]
    assert values(files.scan_delimited(spark, str(tmp_path / "odd"), "s", same_header=True)) == ["Bob"]
    chosen = files.scan_delimited(spark, str(tmp_path / "a.csv"), "s", column="x")
    assert values(chosen) == ["1"]


def test_csv_without_header(spark, tmp_path):
    write(tmp_path, a_dot_csv="Ann,1\nBob,2\n")
    scanned = files.scan_delimited(spark, str(tmp_path), "s", header=False)
    assert values(scanned) == ["Ann", "Bob"]


def test_csv_with_bad_bytes(spark, tmp_path):
    write(tmp_path, a_dot_csv=b"name\nA\xffb\n")
    assert values(files.scan_delimited(spark, str(tmp_path), "s")) == ["A�b"]


def test_tsv_is_strict(spark, tmp_path):
    write(tmp_path, a_dot_tsv="id\tname\n1\tAnn\n", b_dot_tsv="id\tname\n1\tBob\tx\n2\tCid\n")
    scanned = files.scan_delimited(spark, str(tmp_path), "s", sep="\t", strict=True)
    assert values(scanned) == ["Ann"]


def test_json_scan(spark, tmp_path):
    write(
        tmp_path,
        a_dot_json=json.dumps([{"zeta": "Ann", "alpha": 1}, {"zeta": "Bob", "alpha": 2}], indent=1),
        named__b_dot_json=json.dumps([{"user": {"id": 1}, "alpha": 3}]),
        lines__c_dot_json='{"name": 5}\n{"name": "x"}\n',
    )
    assert values(files.scan_json(spark, str(tmp_path / "a.json"), "s")) == ["Ann", "Bob"]
    assert values(files.scan_json(spark, str(tmp_path / "named"), "s")) == ['{"id":"1"}']
    scanned = files.scan_json(spark, str(tmp_path / "lines"), "s", multi_line=False)
    assert values(scanned) == ["5", "x"]


def test_parquet_scan_reads_one_column(spark, tmp_path):
    df = spark.createDataFrame([(1, "Ann", 2.5)], "id int, name string, x double")
    df.write.parquet(str(tmp_path / "t"))
    scanned = files.scan_parquet(spark, str(tmp_path / "t"), "s")
    assert values(scanned) == ["Ann"]
    assert "ReadSchema: struct<name:string,_tmp_metadata_row_index:bigint>" in scanned._jdf.queryExecution().toString()


def test_scan_source(spark, tmp_path):
    write(
        tmp_path,
        s__z_dot_csv="name\nCsv\n",
        s__sub__a_dot_txt="Txt\n",
        s__a_dot_json='[{"name": "Json"}]',
        s__a_dot_tsv="name\nTsv\n",
        s__x_dot_bin="no",
        plain__README_dot_md="Readme\n",
        plain__list="Listed\n",
        plain__sub__deep="no\n",
        plain__x_dot_log="no\n",
    )
    one = spark.createDataFrame([("Parquet",)], "name string")
    one.write.parquet(str(tmp_path / "s" / "p.parquet"))
    scanned = files.scan_source(spark, str(tmp_path), "s")
    assert [r.original for r in scanned.orderBy(*files.SOURCE_PLACE).collect()] == [
        "Csv", "Txt", "Json", "Parquet", "Tsv",
    ]
    assert values(files.scan_source(spark, str(tmp_path), "plain")) == ["Readme", "Listed"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.scan_source(spark, str(tmp_path), "absent")


def test_scan_source_with_mixed_files(spark, tmp_path):
    write(
        tmp_path,
        s__A_dot_CSV='id,name\n1,"multi\nline"\n2,Two\n',
        s__b_dot_TXT="Txt\n",
        s__a_dot_json='[{"id": 1, "username": "Ann"}]',
        s__b_dot_Json='[{"name": "Bob", "id": 2}]',
    )
    for column, value in (("username", "Cid"), ("name", "Dee")):
        one = spark.createDataFrame([(1, value)], f"id int, {column} string")
        one.write.parquet(str(tmp_path / "s" / column))
    scanned = files.scan_source(spark, str(tmp_path), "s").orderBy(*files.SOURCE_PLACE)
    got = [r.original for r in scanned.collect()]
    assert got[:3] == ["multi\nline", "Two", "Txt"]
    assert sorted(got[3:5]) == ["Ann", "Bob"] and sorted(got[5:]) == ["Cid", "Dee"]


def test_unreadable_files_go_to_quarantine(spark, tmp_path):
    write(
        tmp_path,
        s__good_dot_json='[{"name": "Ann"}]',
        s__bad_dot_json='[{"name": "Bob"',
        s__bad_dot_parquet="no table",
        s__t_dot_txt="Txt\n",
        s__x_dot_tsv="name\nTsv\ta\n",
    )
    one = spark.createDataFrame([("Cid",)], "name string").coalesce(1)
    one.write.parquet(str(tmp_path / "s" / "p"))
    root = str(tmp_path)
    assert sorted(values(files.scan_source(spark, root, "s"))) == ["Ann", "Cid", "Txt"]
    folder = f"{root}/s"
    bad = files.quarantine_json(spark, folder, "s", pattern="*.json").collect()
    assert [(r.file.rsplit("/", 1)[1], r.reason) for r in bad] == [("bad.json", "no JSON")]
    scanned = files.scan_parquet(
        spark, folder, "s", skip_unreadable=True, pattern="*.parquet", recursive=True
    )
    listed = manifest.scan_manifest(spark, root)
    lost = files.quarantine_parquet(listed, scanned).collect()
    assert [(r.raw, r.reason) for r in lost] == [("bad.parquet", "no readable row")]
    dropped = files.quarantine_delimited(spark, folder, "s", sep="\t", strict=True, pattern="*.tsv")
    assert sorted(r.reason for r in dropped.collect()) == ["file left out", "too many fields"]


def test_each_file_has_a_column_of_its_own(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    for name, columns in (("a", ["zeta", "beta"]), ("b +%41é", ["beta", "zeta"]), ("c", ["x", "nick"]), ("d", ["x"])):
        table = pa.table({c: pa.array([f"{name[0]}-{c}"]) for c in columns})
        pq.write_table(table, folder / f"{name}.parquet")
    pq.write_table(pa.table({"username": pa.array([None], pa.string()), "x": ["e"]}), folder / "e.parquet")
    (folder / "bad é.parquet").write_text("PAR1 but no table PAR1")
    (folder / "a.json").write_text('[{"zeta": "j1", "beta": "no"}]')
    (folder / "b.json").write_text('[{"beta": "j2", "zeta": "no"}]')
    scanned = files.scan_source(spark, str(tmp_path), "s").where("original IS NOT NULL")
    want = ["a-zeta", "b-beta", "c-nick", "d-x", "j1", "j2"]
    assert sorted(r.original for r in scanned.collect()) == want
    lost = files.unreadable_parquet(manifest.scan_manifest(spark, str(tmp_path))).collect()
    assert [(r.raw, r.reason) for r in lost] == [("bad é.parquet", "no readable footer")]


def test_partly_readable_parquet_is_not_cut_short(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    names = pa.table({"name": [f"name {i}" for i in range(3000)]})
    for file in ("a b+%41.parquet", "c.parquet"):
        pq.write_table(names, folder / file, row_group_size=1000, use_dictionary=False)
    (folder / "bad [1] +.parquet").write_text("no table")
    scanned = files.scan_source(spark, str(tmp_path), "s")
    assert scanned.groupBy("file").count().agg(F.collect_list("count")).first()[0] == [3000, 3000]
    column = pq.ParquetFile(folder / "c.parquet").metadata.row_group(1).column(0)
    broken = bytearray((folder / "c.parquet").read_bytes())
    start = column.data_page_offset
    broken[start : start + column.total_compressed_size] = b"\xff" * column.total_compressed_size
    (folder / "c.parquet").write_bytes(broken)
    with pytest.raises(Exception, match="c.parquet"):
        files.scan_source(spark, str(tmp_path), "s").collect()


def test_merge_lists(spark, tmp_path):
    write(tmp_path, z_list="Zoe\nAnn!\nbob\n", a_list="Bob\nEve\n")
    merged = sources.merge_lists(spark, [str(tmp_path / "z_list"), str(tmp_path / "a_list")], "s")
    names = dedupe.normalize_names(merged, mode="strict")
    order = ("list_no", *sources.FILE_PLACE)
    first = dedupe.dedupe_priority(names, order=order).orderBy(*order)
    assert [(r.nick, r.list_no) for r in first.collect()] == [("zoe", 0), ("bob", 0), ("eve", 1)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.merge_lists(spark, [str(tmp_path / "absent")], "s")


def test_email_tables(spark, tmp_path):
    root = str(tmp_path / "emails")
    full = spark.createDataFrame([("a@b", "a", "b")], "email string, local_part string, domain string")
    full.write.parquet(root)
    full.drop("domain").write.mode("append").parquet(root)
    full.drop("local_part").write.mode("append").parquet(root)
    rows = [tuple(r) for r in files.scan_email_tables(spark, root).collect()]
    assert sorted(rows, key=str) == [("a@b", "a", "b"), ("a@b", "a", None)]


@pytest.fixture
def tree(tmp_path):
    write(
        tmp_path,
        s__data_dot_csv="1", s__data_dot_txt="a\nb\n", s__data_dot_json="1", s__data_dot_parquet="1",
        s__data_dot_tsv="1", s__data_dot_unsupported="x", s__subdir__subdata_dot_csv="1",
        old1__x_dot_md="x", old1__deep__y_dot_md="y", bins__n_dot_txt=b"a\0b", bins__z_dot_zip="text",
    )
    return tmp_path


def test_manifest(spark, tree):
    listed = manifest.scan_manifest(spark, str(tree))
    found = manifest.find_data_files(listed)
    rows = found.where("source = 's'").orderBy("ext_rank", "path").collect()
    assert [r.name for r in rows] == [
        "data.csv", "subdata.csv", "data.txt", "data.json", "data.parquet", "data.tsv",
    ]
    assert [r.name for r in found.where("source = 'old1'").collect()] == ["x.md"]
    registry = spark.createDataFrame([("s", 0), ("old1", 1), ("none", 2)], "slug string, priority int")
    flags = manifest.has_valid_data(listed, registry).collect()
    assert {r.slug: r.has_data for r in flags} == {"s": True, "old1": False, "none": False}
    bad = files.quarantine_manifest(listed).collect()
    assert sorted(r.raw for r in bad) == ["data.unsupported", "z.zip"]
    binary = manifest.binary_flags(spark, str(tree)).where("is_binary")
    assert sorted(r.path.rsplit("/", 1)[1] for r in binary.collect()) == ["n.txt", "z.zip"]


def test_only_first_bytes_are_read(spark, tmp_path):
    # A file of a terabyte without content takes no room, and no time if its first bytes are enough.
    write(tmp_path, a__huge_dot_txt="", a___b_dot_csv="x", a__dot_dot_txt="text", _hid_dot_txt="t" * 2000)
    with open(tmp_path / "a" / "huge.txt", "r+b") as file:
        file.truncate(1 << 40)
    flags = manifest.binary_flags(spark, str(tmp_path), below=None)
    found = {r.path.rsplit("/", 1)[1]: (r.by_name, r.by_content) for r in flags.collect()}
    assert found["huge.txt"] == (False, True)
    assert found["_hid.txt"] == (False, False)
    judged = manifest.binary_flags(spark, str(tmp_path)).where("by_content IS NULL").collect()
    assert [r.path.rsplit("/", 1)[1] for r in judged] == ["huge.txt"]


def test_hidden_and_empty_files_are_listed(spark, tmp_path):
    write(tmp_path, s__a_dot_csv="name\nAnn\n", s__empty_dot_txt="", s__deep___x_dot_csv="name\nBob\n")
    (tmp_path / "s" / ".hidden.csv").write_text("name\nCid\n")
    listed = manifest.scan_manifest(spark, str(tmp_path))
    names = {r["name"]: (r.source, r.depth, r.length) for r in listed.collect()}
    assert names == {
        "a.csv": ("s", 0, 9), "empty.txt": ("s", 0, 0), "_x.csv": ("s", 1, 9), ".hidden.csv": ("s", 0, 9),
    }
    bad = files.quarantine_manifest(listed).select("raw", "reason").collect()
    assert sorted(map(tuple, bad)) == [(".hidden.csv", "hidden file"), ("_x.csv", "hidden file")]
    assert values(files.scan_source(spark, str(tmp_path), "s")) == ["Ann"]


def test_counts_of_the_manifest(spark, tree):
    listed = manifest.scan_manifest(spark, str(tree))
    slug = F.regexp_extract("file", r"/([^/]+)/[^/]+$", 1)
    raw = sources.scan_raw_lines(spark, str(tree), slug, pattern="*.txt", recursive=True)
    binary = spark.createDataFrame([(f"file:{tree}/bins/n.txt",)], "file string")
    counted = stats.raw_counts(raw, binary)
    assert [(r.source, r.n_lines) for r in counted.collect()] == [("s", 2)]
    totals = {r.source: tuple(r)[1:] for r in stats.dir_totals(listed, counted).collect()}
    assert totals == {"s": (7, 10, 2), "old1": (2, 2, 0), "bins": (2, 7, 0)}


def test_validate_files(spark, tree):
    listed = manifest.scan_manifest(spark, str(tree)).withColumn(
        "path", F.regexp_replace("path", "^file:/+", "/")
    )
    wanted = [f"{tree}/s/data.csv", f"{tree}/s/", f"{tree}/absent", f"{tree}/s/dat"]
    expected = spark.createDataFrame([(p,) for p in wanted], "path string")
    checked = manifest.validate_files(expected, listed)
    assert {r.path.rsplit("/", 1)[1]: r.valid for r in checked.collect()} == {
        "data.csv": True, "s": True, "absent": False, "dat": False,
    }
    assert tuple(manifest.validation_summary(checked, 2).first()) == (2, 2, True)
    assert tuple(manifest.validation_summary(checked, 3).first()) == (2, 2, False)
    assert manifest.validation_summary(checked).first().as_expected
    valid = checked.where("valid")
    listing = spark.createDataFrame([("s", wanted[0]), ("t", wanted[2])], "source string, path string")
    assert [r.source for r in files_by_source(valid, listing).collect()] == ["s"]


def test_registry(spark):
    records = [
        {"slug": "test1", "type": "git", "ref": "r1", "repo": "a/b"},
        {"slug": "test2", "type": "http", "ref": "r2", "url": "http://x", "is_email": True},
    ]
    registry = source_registry(spark, records)
    rows = registry.orderBy("priority").collect()
    assert [(r.slug, r.is_email, r.priority) for r in rows] == [("test1", False, 0), ("test2", True, 1)]
    assert tuple(check_registry(registry).first()) == (2, True, True)
    for wrong in (
        [{"slug": "x", "type": "ftp", "ref": "r"}],
        [records[0], records[0]],
        [{"slug": "x", "type": "git"}],
        [{"slug": "x", "type": "git", "ref": "r", "branch": "main"}],
    ):
        with pytest.raises(ValueError):
            source_registry(spark, wrong)


def test_half_written_output_is_replaced(spark, tmp_path):
    words = spark.createDataFrame([("a",), ("b",)], "value string")
    half = tmp_path / "out"
    write(half, _temporary__0__part="x", part_dash_0_dot_txt="left behind\n")
    sinks.write_lines(words, str(half), "value")
    assert sorted(r.value for r in spark.read.text(str(half)).collect()) == ["a", "b"]
    sinks.write_lines(words.where("value = 'a'"), str(half), "value")
    assert spark.read.text(str(half)).count() == 2
    table = str(tmp_path / "table")
    sinks.write_table(words, table)
    (tmp_path / "table" / "_SUCCESS").unlink()
    sinks.write_table(words.where("value = 'a'"), table)
    assert [r.value for r in spark.read.parquet(table).collect()] == ["a"]
    sinks.write_table(words, table, force=True)
    assert spark.read.parquet(table).count() == 2


def test_chunks_take_one_job(spark, tmp_path):
    numbered = spark.range(2500).select(F.col("id").alias("ord"), F.col("id").cast("string").alias("v"))
    path = str(tmp_path / "chunks")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chunks", "chunks")
    sinks.write_chunks(ordering.assign_chunks(numbered, 100), path, "v")
    # The last stages of one write; no job of its own counts chunks or samples bounds.
    plans = tracker.getJobIdsForGroup("chunks")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(plans) <= 2
    parts = [p for p in (tmp_path / "chunks").glob("chunk=*/*.txt")]
    assert len(parts) == 25
    for part in parts:
        first = (int(part.parent.name.split("=")[1]) - 1) * 100
        assert part.read_text().split() == [str(n) for n in range(first, first + 100)]


def test_spread_by_size(spark, monkeypatch):
    monkeypatch.setattr(sources, "TASK_BYTES", 20_000, raising=False)
    rows = [(i, "s", "word " * 400) for i in range(400)] + [(None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    spread = sources.spread(docs, "doc_id").withColumn("task", F.spark_partition_id())
    tasks = spread.groupBy("task").agg(F.sum(F.length("text")).alias("size")).collect()
    assert len(tasks) > 20
    # About 20,000 bytes each, as the hashes of the keys deal them out.
    assert max(t.size or 0 for t in tasks) < 100_000
    assert spread.count() == 401
    empty = sources.spread(docs.limit(0), "doc_id")
    assert empty.count() == 0
