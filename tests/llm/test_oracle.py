"""Queries that SQL can express, against the other engine on the smallest tables."""

import glob
import os

import duckdb
import pytest

from stratiform.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    result = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(str(r[names.index(c)]) for c in columns) for r in result.fetchall())
