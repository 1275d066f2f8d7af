"""Every cohort query against the other engine, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from stratiform import queries as cohort

from conftest import SMALL


def normal(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(normal, v)) + "]"
    return normal(v.tolist()) if hasattr(v, "tolist") else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(cohort.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    rows = sorted(tuple(normal(r[c]) for c in columns) for r in df.collect())
    assert rows
    if name in cohort.ORACLE_SQL:
        result = con.execute(cohort.ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert rows == sorted(tuple(normal(r[names.index(c)]) for c in columns) for r in result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
