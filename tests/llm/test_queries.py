"""Queries agree with their SQL on the given tables."""

import math

import duckdb
import pytest

from postsift.llm.queries import QUERIES
from postsift.llm.sql import SQL


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


@pytest.mark.parametrize("name", SQL)
def test_sql_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    twin = con.execute(SQL[name])
    names = [c[0] for c in twin.description]
    assert columns == sorted(names)
    theirs = in_order([tuple(r[names.index(c)] for c in columns) for r in twin.fetchall()])
    ours = in_order([tuple(r) for r in df.select(*columns).collect()])
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs, strict=True):
        assert all(math.isclose(x, y, rel_tol=1e-12) if isinstance(x, float) else x == y for x, y in zip(a, b, strict=True)), (a, b)
