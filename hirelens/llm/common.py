"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hirelens.session import give_back, new_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoints(spark: SparkSession) -> None:
    """Make sure ``checkpoint()`` goes to the shared folder."""
    shared_dir(spark)


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8: bytes split at exactly these six."""
    return text.encode().split() if text else []


def blocks(
    batches: Iterator[pa.RecordBatch], sized: str, limit: int = 8_000_000
) -> Iterator[pa.Table]:
    """Batches cut or joined to blocks whose ``sized`` texts have about ``limit`` bytes.

    A text longer than the limit makes a block of its own, so memory follows the longest text.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        lengths = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(sized)]
        for row, length in enumerate(lengths):
            if size and size + length > limit:
                if row > start:
                    held.append(batch.slice(start, row - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, row
            size += length
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
    held.clear()
    give_back()
