"""Every registered query against its SQL in DuckDB on the smallest tables."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from check_queries import sorted_rows
from hirelens.plans import catalog, inputs

QUERIES, ORACLES = catalog.queries(), catalog.oracles()
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = sorted_rows(df.columns, df.collect())
    assert "CartesianProduct" not in df._jdf.queryExecution().executedPlan().toString()
    cursor = db.execute(ORACLES[name])
    assert got == sorted_rows([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("missing", ["hirelens.llm", "corpus_pipeline", "zstandard", "xxhash", "public_tokenizers"])
def test_entry_goes_without_what_cannot_be_imported(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q))"
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert told.stdout.split() == [str(len(catalog.queries())), "True"], told.stderr


def test_parsing_deals_one_row_group_to_all_cores(spark, tmp_path):
    """A row group is read by one task, whatever the number of splits; parsing it is not left to that task."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        parsed = inputs.parsed(spark, str(tmp_path))
        tasks = parsed.select(F.spark_partition_id().alias("t")).groupBy("t").count().collect()
        rows = parsed.select("doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(tasks) >= 16 and max(r["count"] for r in tasks) < sum(r["count"] for r in tasks) / 4
    assert sorted(rows) == sorted(inputs.parsed_table(spark, "/root/testdata/sf0.001").select("doc_id").collect())
