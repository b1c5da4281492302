"""Delimited text with line breaks in cells, held against Spark's own reader of whole files."""

import csv
import random

import pytest

from listwright.sources import files, records


@pytest.fixture
def small_splits(spark):
    # Else a file is cut into as many splits as there are cores.
    values = {"maxPartitionBytes": None, "openCostInBytes": 1, "minPartitionNum": 1}
    before = {n: spark.conf.get(f"spark.sql.files.{n}", None) for n in values}

    def cut(size):
        for n, v in values.items():
            spark.conf.set(f"spark.sql.files.{n}", str(v or size))

    yield cut
    for n, v in before.items():
        spark.conf.unset(f"spark.sql.files.{n}") if v is None else spark.conf.set(f"spark.sql.files.{n}", v)


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as file:
        file.write(text)
    return str(folder / name)


def cells_of(rng):
    return rng.choice([
        "plain", "", 'say ""hi""', "two\nlines", "a,b", '"', '""', "\n\n", "é\n", " x ", ",", "\r\n",
        'end"', "long " * 30, "tab\t", "'", "\\",
    ])


def random_csv(seed, rows, end="\n", columns=3):
    rng = random.Random(seed)
    lines = [",".join(f"h{i}" for i in range(columns))]
    for _ in range(rows):
        cells = []
        for _ in range(columns):
            cell = cells_of(rng)
            must = any(c in cell for c in ',"\n\r')
            cells.append('"' + cell.replace('"', '""') + '"' if must or rng.random() < 0.3 else cell)
        lines.append(",".join(cells))
    return end.join(lines) + rng.choice(["", end, end + end])


def by_spark(spark, path, header=True):
    """The first cell of each record as Spark reads the file in one task."""
    table = spark.read.options(multiLine=True, header=header, escape='"', lineSep="\n").csv(path)
    return sorted(map(repr, (r[0] for r in table.select(table.columns[0]).collect())))


@pytest.mark.parametrize("size", [90, 1 << 20])
@pytest.mark.parametrize("seed", range(2))
def test_random_files(spark, tmp_path, small_splits, size, seed):
    text = random_csv(seed, 60)
    path = write(tmp_path, "a.csv", text)
    want = by_spark(spark, path)
    small_splits(size)
    rows = records.scan_cells(spark, path, "s").where("NOT surplus")
    assert sorted(repr(r.original) for r in rows.collect()) == want
    with open(path, newline="", encoding="utf-8") as file:
        assert len(list(csv.reader(file))) - 1 == len(want)


ODD = {
    "stray": 'a,b\n5" pipe,x\n6",y\nz "q" w,v\n"open, ""x""\nmore",k\n,"\n"\n',
    "unended": 'a,b\n1,2\n"never\nended,3\n4,5\n',
    "crlf": 'a,b\r\n"one\r\ntwo",x\r\n\r\nthree,y\r\n',
    "blank": "\n\na,b\n\n1,2\n\n\n3,4\n\n",
    "mark": "\ufeffa,b\n1,2\n",
    "after": 'a,b\n"x"y,1\n"x" ,2\n"p"q"r",3\n "s",4\n',
    "header": '"a\na",b\n"1\n1",2\n',
    "only": "a,b\n",
}


@pytest.mark.parametrize("name", sorted(ODD))
@pytest.mark.parametrize("size", [5, 1 << 20])
def test_odd_files(spark, tmp_path, small_splits, name, size):
    path = write(tmp_path, f"{name}.csv", ODD[name])
    want = by_spark(spark, path)
    small_splits(2 if name == "header" and size == 5 else size)
    if name == "header" and size == 5:
        with pytest.raises(Exception, match="no header"):
            records.scan_cells(spark, path, "s").collect()
        return
    got = sorted(repr(r.original) for r in records.scan_cells(spark, path, "s").collect())
    if name == "crlf":
        # Spark's reader is told one line end and keeps the other sign in the last cell only.
        want = ["'one\\r\\ntwo'", "'three'"]
    if name == "unended":
        # A cell that nothing closes ends with its last line.
        want = ["'1'", "'never\\nended,3\\n4,5'"]
    assert got == want


def test_scan_delimited(spark, tmp_path, small_splits):
    folder = tmp_path / "in"
    write(folder, "a.csv", 'id,name\n1,"Ann\nLee"\n2,Bob,3\n4,"C ""c"""\n')
    write(folder, "b.csv", 'username,other\n"D\n\nd",x\n')
    write(folder, "c.csv", "zeta,beta\nz,b\n")
    small_splits(7)
    scanned = files.scan_delimited(spark, str(folder), "s", multi_line=True)
    assert sorted(r.original for r in scanned.collect()) == ["Ann\nLee", 'C "c"', "D\n\nd", "z"]
    assert scanned.rdd.getNumPartitions() > 3
    bad = files.quarantine_delimited(spark, str(folder), "s", multi_line=True).collect()
    assert [(r.reason, r.raw) for r in bad] == [("too many fields", "2,Bob,3")]
    strict = files.scan_delimited(spark, str(folder), "s", multi_line=True, strict=True)
    assert sorted(r.original for r in strict.collect()) == ["D\n\nd", "z"]
    chosen = files.scan_delimited(spark, str(folder / "c.csv"), "s", multi_line=True, column="beta")
    assert [r.original for r in chosen.collect()] == ["b"]
    plain = files.scan_delimited(spark, str(folder / "c.csv"), "s", multi_line=True, header=False)
    assert [r.original for r in plain.orderBy("line_no").collect()] == ["zeta", "z"]


def test_other_join(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(records, "BROADCAST_SPLITS", 0)
    path = write(tmp_path, "a.csv", random_csv(9, 80))
    want = by_spark(spark, path)
    small_splits(50)
    rows = records.scan_cells(spark, path, "s")
    assert sorted(repr(r.original) for r in rows.collect()) == want
