"""Queries that SQL can state, against it."""

import glob
import os

import duckdb
import pytest
from check_queries import sorted_rows
from hirelens.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, sf_dir, name):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, sf_dir)
    cursor = db.execute(queries.ORACLES[name])
    want = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert sorted_rows(df.columns, df.collect()) == want


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs_on_the_smallest_tables(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
