"""Queries of the package against their SQL, on whole tables."""

import duckdb
import pytest

from cdclake.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    expected = connection.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    got = QUERIES[name](spark, DATA).select(*columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs_on_the_whole_table(spark, name):
    got = QUERIES[name](spark, DATA)
    if name.startswith(("op3", "op5", "op9", "op11")):
        assert got.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
