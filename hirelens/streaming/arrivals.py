"""Raw records as they arrive: the archive folder as a file stream.

The parser is a narrow projection, so ``parse_postings`` takes a stream as it takes a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.operators.postings import parse_postings
from hirelens.operators.records import raw_to_columns


def stream_raw_jobs(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of raw job records, one record per line."""
    return (
        spark.readStream.schema(schemas.RAW_JOB)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def new_jobs(raw: DataFrame, within: str = "30 days") -> DataFrame:
    """Each job once, as long as it comes back within the given time. State older than that goes.

    A record without an id is keyed by its own content, so that only its copies are dropped.
    """
    seen = raw.select(
        "*",
        F.coalesce(
            F.col("job_identity.job_id_raw"), F.concat(F.lit("-"), F.md5(F.to_json(F.struct("*"))))
        ).alias("job_id_raw"),
        F.try_to_timestamp("scrape_metadata.scrape_timestamp").alias("collected"),
    )
    return seen.withWatermark("collected", within).dropDuplicatesWithinWatermark(["job_id_raw"])


def parsed_stream(raw: DataFrame) -> DataFrame:
    return parse_postings(raw_to_columns(raw))
