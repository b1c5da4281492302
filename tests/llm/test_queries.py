"""Queries of the operators against their SQL twins, on the smallest test tables."""

import os
from collections import Counter

import duckdb
import pytest

from listwright.llm.oracle import ORACLE
from listwright.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query(spark, twin, key):
    got = QUERIES[key](spark, SF).toArrow()
    want = twin.sql(ORACLE[key]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    columns = sorted(got.column_names)
    mine, theirs = (
        Counter(zip(*(table.column(c).to_pylist() for c in columns))) for table in (got, want)
    )
    assert mine == theirs, (list((mine - theirs))[:3], list((theirs - mine))[:3])


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_on_whole_table(spark, key):
    """What the query returns is held against a plain version in the operator's own tests."""
    table = "pages" if key.startswith(("op2", "op3")) else "documents"
    rows = QUERIES[key](spark, SF).count()
    whole = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert 0 < rows <= whole if key.startswith("op5") else rows == whole
