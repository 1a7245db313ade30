"""Runs in a folder: each attempt is written aside and becomes visible by one commit record.

A folder holds ``attempt=<id>/<run columns>/files`` and ``_commits``. A commit record says which runs
an attempt holds; of each run the attempt committed last counts, so writing a run again replaces it
and no other, and an attempt that broke off is never read. A record is a single file that is moved
into place, which the engine's committer does at the end of its write; nothing is written over.

Run columns are kept as text; null and empty are the same run. Attempts that no commit names, or that were replaced, can be removed
by a retention rule once no reader of the older state is left.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "attempt string, at bigint, run array<string>"


def write_runs(
    df: DataFrame, path: str, columns: Sequence[str], fmt: str, run: Sequence[str] | None = None
) -> str:
    """Write rows below ``path`` by the run in ``columns``, commit, and return the attempt's folder.

    Runs written before are replaced. ``run`` names the one run that the rows are; it is replaced even
    if there are no rows. Without it runs are those found in the rows.
    """
    folder = write_attempt(df, path, columns, fmt)
    commit(df.sparkSession, path, folder, columns, fmt, run)
    return folder


def write_attempt(df: DataFrame, path: str, columns: Sequence[str], fmt: str) -> str:
    """Write rows aside; nobody sees them before ``commit``."""
    folder = f"{path}/attempt={uuid.uuid4().hex}"
    named = df.withColumns({c: F.col(c).cast("string") for c in columns})
    named.write.partitionBy(*columns).format(fmt).save(folder)
    return folder


def commit(
    spark: SparkSession, path: str, folder: str, columns: Sequence[str], fmt: str, run: Sequence[str] | None = None
) -> None:
    """Make the runs of an attempt the ones that count, all at once."""
    attempt = folder.rsplit("attempt=", 1)[1]
    if run is not None:
        found = [list(run)]
    else:  # folder names only, no data is read
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = spark.read.schema(schema).format(fmt).load(folder).distinct().collect()
        found = [[r[c] or "" for c in columns] for r in rows]
    if found:
        record = spark.createDataFrame([(attempt, time.time_ns(), r) for r in found], COMMIT)
        record.coalesce(1).write.json(f"{path}/_commits/{attempt}")


def commits(spark: SparkSession, path: str) -> DataFrame | None:
    """All commit records of a folder; ``None`` if it was not written by ``write_runs``."""
    try:
        return spark.read.schema(COMMIT).option("recursiveFileLookup", True).json(f"{path}/_commits")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def live_runs(spark: SparkSession, path: str) -> list[tuple[str, list[str]]] | None:
    """``(attempt, run)`` of every run, from the attempt that was committed last; the newest is last."""
    records = commits(spark, path)
    if records is None:
        return None
    newest = records.groupBy("run").agg(F.max(F.struct("at", "attempt")).alias("last"))
    rows = newest.orderBy("last", "run").collect()  # one row per run
    return [(r["last"]["attempt"], r["run"]) for r in rows]


def read_runs(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str], fmt: str, **options: object
) -> DataFrame | None:
    """The rows of all runs that count, with the run columns behind those of ``schema``.

    Filters on run columns prune folders. ``None`` if the folder was not written by ``write_runs``.
    """
    live = live_runs(spark, path)
    if live is None:
        return None
    return rows_of(spark, path, schema, columns, fmt, live, options)


def read_newest(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str], fmt: str
) -> DataFrame | None:
    """The rows of the attempt that was committed last: the newest commit is the pointer to it."""
    live = live_runs(spark, path)
    if live is None:
        return None
    newest = [(attempt, run) for attempt, run in live if attempt == live[-1][0]] if live else []
    return rows_of(spark, path, schema, columns, fmt, newest, {})


def rows_of(spark, path, schema, columns, fmt, live, options) -> DataFrame:
    text = [T.StructField(c, T.StringType()) for c in ("attempt", *columns)]
    fields = [f for f in schema.fields if f.name not in columns]
    rows = spark.read.schema(T.StructType([*fields, *text])).format(fmt).options(**options).load(path)
    values = {c: F.coalesce(c, F.lit("")) for c in columns}  # a folder name has no empty text
    name = F.concat_ws("\u0001", "attempt", *values.values())
    names = ["\u0001".join([attempt, *run]) for attempt, run in live]
    rows = rows.filter(name.isin(names)) if names else rows.filter(F.lit(False))
    return rows.select(*[f.name for f in fields], *[v.alias(c) for c, v in values.items()])
