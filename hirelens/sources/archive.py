"""Reading the raw archive and the versioned dataset. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import schemas
from hirelens.sources import runs
from hirelens.sources.array_files import read_arrays as array_files_of
from hirelens.sources.sinks import DATASET_RUN, RUN, SEARCH_RUN

CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, array_files: bool) -> DataFrame:
    if array_files:
        return array_files_of(spark, path, schema, CORRUPT)
    if fmt == "json":
        with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "pathGlobFilter": "*.json"}
        found = runs.read_runs(spark, path, with_corrupt, SEARCH_RUN, "json", **options)
        if found is not None:
            return found
        return spark.read.schema(with_corrupt).options(**options).json(path)
    found = runs.read_runs(spark, path, schema, SEARCH_RUN, fmt)
    return spark.read.schema(schema).format(fmt).load(path) if found is None else found


def scan_raw_jobs(
    spark: SparkSession, path: str, fmt: str = "json", array_files: bool = False
) -> DataFrame:
    """Raw job records below ``path``; of what the library wrote, the last attempt of each run.

    ``array_files=True`` reads files that hold one JSON array each, in as many tasks as their size
    asks for. The library's own files have a record per line. Records without an identity, and
    what is no JSON, are left out; ``corrupt_rows`` lists the latter.
    """
    raw = _read(spark, path, schemas.RAW_JOB, fmt, array_files)
    return raw.filter(F.col("job_identity.job_id_raw").isNotNull()).select(*schemas.RAW_JOB.names)


def scan_raw_companies(
    spark: SparkSession, path: str, fmt: str = "json", array_files: bool = False
) -> DataFrame:
    raw = _read(spark, path, schemas.RAW_COMPANY, fmt, array_files)
    named = raw.filter(F.col("company_identity.company_id_hash").isNotNull())
    return named.select(*schemas.RAW_COMPANY.names)


def corrupt_rows(spark: SparkSession, path: str, array_files: bool = False) -> DataFrame:
    """Text that is no JSON, with the file it stands in. In an array file that is the broken element."""
    raw = _read(spark, path, schemas.RAW_JOB, "json", array_files)
    file = F.col("file") if array_files else F.input_file_name()
    return raw.filter(F.col(CORRUPT).isNotNull()).select(
        file.alias("file"), CORRUPT, F.col("job_identity").isNull().alias("empty")
    )


def scan_listings(spark: SparkSession, path: str) -> DataFrame:
    found = runs.read_runs(spark, path, schemas.CARD, RUN, "json")
    if found is None:
        return spark.read.schema(schemas.CARD).json(path)
    return found.drop(*RUN)


def scan_parsed(spark: SparkSession, path: str) -> DataFrame:
    """Parsed postings that were written as JSON, the last attempt of each run."""
    found = runs.read_runs(spark, path, schemas.PARSED_JOB, RUN, "json")
    if found is None:
        return spark.read.schema(schemas.PARSED_JOB).json(path)
    return found.drop(*RUN)


def scan_reports(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    found = runs.read_runs(spark, path, schema, RUN, "json")
    return spark.read.schema(schema).json(path) if found is None else found.drop(*RUN)


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages. Columns not asked for later are not read."""
    return spark.read.schema("page_id bigint, url string, html string").parquet(path)


def scan_dataset(spark: SparkSession, path: str) -> DataFrame:
    """All versions and runs of the parsed dataset; filters on these two prune partitions."""
    by_run = T.StructType([*schemas.PARSED_JOB.fields, T.StructField("run_ts", T.StringType())])
    found = runs.read_runs(spark, path, by_run, DATASET_RUN, "parquet")
    return spark.read.schema(by_run).parquet(path) if found is None else found.select(*by_run.names)


def scan_latest(spark: SparkSession, path: str) -> DataFrame:
    """The run of the parsed dataset that was written last."""
    found = runs.read_newest(spark, path, schemas.PARSED_JOB, DATASET_RUN, "parquet")
    if found is None:
        raise FileNotFoundError(f"no run was written to {path}")
    return found.select(*schemas.PARSED_JOB.names)
