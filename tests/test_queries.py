"""Every registered query of the library against its DuckDB twin on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from fathom.plans.queries import QUERIES, SQL

SF = Path("/root/testdata/sf0.001")


def text(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else repr(round(v, 9))
    return str(v)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in SF.glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, db, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    found = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    cursor = db.execute(SQL[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    assert found == sorted(tuple(text(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, str(SF)).columns
