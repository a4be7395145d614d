"""Every sample query gives the rows of its SQL."""

import datetime
import os

import duckdb
import pytest

from cdclake.plans.sample_queries import QUERIES, SQL

DATA = os.environ.get("QUERY_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no sample data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def rows_by_name(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    got = QUERIES[name](spark, DATA)
    expected = database.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(columns)
    rows = rows_by_name([tuple(r) for r in got.collect()], got.columns)
    assert rows == rows_by_name(expected.fetchall(), columns)
    assert rows
    assert not any(isinstance(v, datetime.datetime) for r in rows for v in r)


def test_sql_types(spark, database):
    for name in ("merge_changes", "change_report", "state_report", "latency", "view_movement", "key_mismatches"):
        got = dict(QUERIES[name](spark, DATA).dtypes)
        described = database.execute(f"DESCRIBE {SQL[name]}").fetchall()
        assert {c: TYPES[t] for c, t in got.items()} == {row[0]: row[1] for row in described}, name
