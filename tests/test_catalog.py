"""Every query runs, and agrees with its SQL twin on the given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.inputs import SCHEMAS
from catalog.queries import QUERIES
from catalog.sql import SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


def test_which_queries_have_no_sql():
    assert set(SQL) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SQL)
def test_sql_twin(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    twin = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(twin.columns)
    ours = [tuple(r) for r in df.select(*columns).collect()]
    theirs = twin.select(*[f'"{c}"' for c in columns]).fetchall()
    assert in_order(ours) == in_order(theirs)


@pytest.mark.parametrize("name", ["streamed_verdicts", "streamed_large_model"])
@pytest.mark.parametrize("files", [1, 3])
def test_streams_of_a_table_of_one_or_more_files(spark, tmp_path, name, files):
    """Tables that are folders of files were streamed as if they had no rows."""
    rows = [(i, ("cheap pills now" if i % 2 else "a quiet walk") + f" w{i}", "en", "s", 20) for i in range(12)]
    spark.createDataFrame(rows, SCHEMAS["documents"]).repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, i % 2, (i + i // 6) % 2) for i in range(12)]
    spark.createDataFrame(labels, SCHEMAS["labels"]).write.parquet(str(tmp_path / "labels.parquet"))
    assert sorted(r.doc_id for r in QUERIES[name](spark, str(tmp_path)).collect()) == list(range(12))
