"""The statements next to their queries on the smallest test tables."""

import os

import duckdb
import pytest

from roadrisk.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_statement_gives_the_same_rows(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = connection.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    names = sorted(want.columns)
    rows = lambda frame: sorted(map(tuple, frame[names].fillna("none").astype(str).to_numpy().tolist()))
    size = connection.execute(f"SELECT count(*) FROM {'pages' if 'page_id' in names else 'documents'}").fetchone()[0]
    assert sorted(got.columns) == names and rows(got) == rows(want) and len(got) == size > 0
