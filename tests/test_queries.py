"""Every registered query that SQL can express against that SQL, on the smallest tables."""

import collections
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = collections.Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == collections.Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
