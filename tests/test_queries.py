"""Every query against its SQL twin, on the smallest test tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _rows(table):
    columns = sorted(table.column_names)
    return Counter(zip(*(table.column(c).to_pylist() for c in columns)))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, twin, key):
    got = entry.queries()[key](spark, SF).toArrow()
    want = twin.sql(entry.oracle_sql()[key]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    types = {f.name: _plain(f.type) for f in got.schema}
    assert types == {f.name: _plain(f.type) for f in want.schema}
    mine, theirs = _rows(got), _rows(want)
    assert sum(mine.values()) > 0 or sum(theirs.values()) == 0
    assert mine == theirs, (list((mine - theirs))[:3], list((theirs - mine))[:3])


def _plain(kind):
    return str(kind).replace("large_", "")


def test_entry(spark):
    assert entry.entry(spark).columns == ["nick", "priority", "file", "line_no", "original"]
