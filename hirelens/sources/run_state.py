"""What is known of each job after a run: carried on from run to run, so the archive is not read again.

The state has one row per job: the hash of its content, the last run that had it, and in how many runs
it was. A run is merged with the state of the run before it. States are written in buckets by job,
so a merge shuffles the new run and not the state. Each state belongs to its run and is committed
like any run (see ``runs``): working a run over starts from the state before that run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.sources import runs

BUCKETS = 64
COLUMNS = ("key", "last_run", "last_hash", "runs")


def state_before(spark: SparkSession, path: str, run: str | None = None) -> DataFrame | None:
    """The state of the last run in front of ``run`` (of the last one at all), ``None`` if there is none.

    Run names are compared as text, as times in ISO form sort.
    """
    known = runs.live_runs(spark, path) or []
    earlier = [(name[0], attempt) for attempt, name in known if run is None or name[0] < run]
    if not earlier:
        return None
    _, attempt = max(earlier)
    name = f"state_{attempt}"
    if not spark.catalog.tableExists(name):  # another session wrote it
        folder = f"{path}/attempt={attempt}"
        kind, buckets = spark.read.json(f"{path}/_layout/{attempt}").select("kind", "buckets").first()
        spark.sql(
            f"CREATE TABLE {name} (key {kind}, last_run STRING, last_hash STRING, runs BIGINT) USING parquet"
            f" CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
    return spark.table(name)


def advance(
    new: DataFrame, path: str, run: str, key: str, content_hash: str, buckets: int = BUCKETS
) -> DataFrame:
    """Merge the rows of one run into the state below ``path``; what the run says of each of its jobs.

    Gives ``key, run, content_hash, previous_hash, run_no, change`` as ``change_history`` does over all
    runs, if runs come in order. Of several rows of a job the smallest hash counts. Rows without a
    key are no job's history: each is ``new``, and the state does not keep them.
    """
    spark = new.sparkSession
    before = state_before(spark, path, run)
    named = new.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
    fresh = named.agg(F.min(F.col(content_hash).cast("string")).alias("hash"))
    if before is None:
        kind = new.schema[key].dataType.simpleString()
        before = spark.createDataFrame([], f"key {kind}, last_run string, last_hash string, runs bigint")
    both = fresh.withColumn("here", F.lit(True)).join(before, "key", "full")
    here = F.col("here").isNotNull()
    merged = both.select(
        "key",
        F.when(here, F.lit(run)).otherwise(F.col("last_run")).alias("last_run"),
        F.when(here, F.col("hash")).otherwise(F.col("last_hash")).alias("last_hash"),
        (F.coalesce("runs", F.lit(0)) + here.cast("bigint")).alias("runs"),
    )
    write_state(merged, path, run, buckets)
    told = fresh.join(before, "key", "left").select(
        F.col("key").alias(key),
        F.lit(run).alias("run"),
        F.col("hash").alias(content_hash),
        F.col("last_hash").alias("previous_hash"),
        (F.coalesce("runs", F.lit(0)) + 1).cast("int").alias("run_no"),
        F.when(F.col("runs").isNull(), "new")
        .when(F.col("last_hash").eqNullSafe(F.col("hash")), "same")
        .otherwise("changed")
        .alias("change"),
    )
    nameless = new.filter(F.col(key).isNull()).select(
        key,
        F.lit(run).alias("run"),
        F.col(content_hash).cast("string").alias(content_hash),
        F.lit(None).cast("string").alias("previous_hash"),
        F.lit(1).alias("run_no"),
        F.lit("new").alias("change"),
    )
    return told.unionByName(nameless)


def write_state(state: DataFrame, path: str, run: str, buckets: int) -> None:
    """Write a state in buckets by key, and make it that of its run."""
    spark, attempt = state.sparkSession, uuid.uuid4().hex
    folder = f"{path}/attempt={attempt}"
    kind = state.schema["key"].dataType.simpleString()
    spread = state.select(*COLUMNS).repartition(buckets, "key")
    spread.write.bucketBy(buckets, "key").sortBy("key").option("path", folder).format("parquet").saveAsTable(
        f"state_{attempt}"
    )
    layout = spark.createDataFrame([(kind, buckets)], "kind string, buckets int")
    layout.coalesce(1).write.json(f"{path}/_layout/{attempt}")
    runs.commit(spark, path, folder, ("run",), "parquet", run=[run])


def unseen(cards: DataFrame, path: str, key: str, run: str | None = None) -> DataFrame:
    """Cards whose ``key`` no run in front of ``run`` had. Cards without a key stay."""
    before = state_before(cards.sparkSession, path, run)
    if before is None:
        return cards
    return cards.join(before.select(F.col("key").alias("_known")), F.col(key) == F.col("_known"), "left_anti")
