"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, engine, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = ordered([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    relation = engine.sql(sql)
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema} == types
    at = [relation.columns.index(c) for c in columns]
    assert got == ordered([tuple(plain(r[i]) for i in at) for r in relation.fetchall()])


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 10


def test_names_are_sound():
    assert set(entry.oracle_sql()) <= set(entry.queries())
