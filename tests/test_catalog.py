"""Every query against its SQL form in another engine."""

import datetime as dt

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallygrid.plans.catalog import load

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
ROWS_ONLY = {"collection_samples"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return str(value)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(load())))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(cell(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert ours == theirs


def test_only_known_queries_lack_sql():
    assert set(load()) - set(oracle_sql()) == ROWS_ONLY


def test_samples_are_three_documents_per_collection(spark):
    samples = queries()["collection_samples"](spark, FOLDER)
    assert {(r["collection"], r["count"]) for r in samples.groupBy("collection").count().collect()} \
        == {("sales", 3), ("customers", 3)}


def test_entry_runs(spark):
    assert entry(spark).count() > 0
