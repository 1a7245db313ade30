"""The archive over runs: what is new, what repeats, what changed.

A key may hold a large share of all rows. So nothing here sorts or collects a key's rows in one
task: repeats are removed by aggregates that combine before the shuffle, and windows only see what
is left, at most one row per key and run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from hirelens.functions.text import hash_content, is_blank


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False
) -> DataFrame:
    """One whole row per key: the first (or last) by ``order``, whatever the partitioning; of rows
    alike in that, the one with the smaller (larger) hash, and equal rows once.

    Winners are found on keys and places alone, which combine before the shuffle. Whole rows are
    then only compared with the winner of their key and place, by hash: none is sorted, and rows of
    one key spread by their places.
    """
    return winning_rows(df, keys, order, {}, last).select(*df.columns)


def winning_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    more: Mapping[str, Column],
    last: bool = False,
) -> DataFrame:
    """``first_rows`` with ``more`` aggregates over all rows of the key."""
    values = [F.to_json(F.struct(f.name)) if has_map(f.dataType) else F.col(f.name) for f in df.schema]
    place = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], F.xxhash64(*values).alias("_h"))
    placed = df.withColumn("_place", place)
    best = (F.max if last else F.min)("_place")
    winners = placed.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(
        best.alias("_best"), *[value.alias(name) for name, value in more.items()]
    )
    same = F.col("_place") == F.col("_best")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    picked = placed.join(winners.hint("shuffle_hash"), same)
    if any(has_map(f.dataType) for f in df.schema):  # what is left of a key are its winner and equal rows
        picked = picked.dropDuplicates([f"_key_{i}" for i in range(len(keys))])
        return picked.select(*df.columns, *more)
    return picked.select(*df.columns, *more).distinct()


def has_map(kind: T.DataType) -> bool:
    """Whether a type is a map or holds one; such values have no hash and cannot be compared."""
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def dedup_jobs(
    df: DataFrame, key: str = "job_id_raw", order: Sequence[str] = ("page", "position")
) -> DataFrame:
    """First occurrence of each job within and across pages. Rows without a key all stay: they are
    keyed by their place, which is unique."""
    own = F.coalesce(F.col(key).cast("string"), F.to_json(F.struct(*order)))
    return first_rows(df.withColumn("_key", own), ["_key"], [F.col(o) for o in order]).drop("_key")


def dedup_by_id(df: DataFrame, key: str, ts: str, *tie_break: str) -> DataFrame:
    """Latest record of each id over all runs. Rows without an id all stay."""
    named = df.filter(F.col(key).isNotNull())
    latest = first_rows(named, [key], [F.col(ts), *map(F.col, tie_break)], last=True)
    return latest.unionByName(df.filter(F.col(key).isNull()))


def skip_seen(cards: DataFrame, archive: DataFrame) -> DataFrame:
    """Cards whose job is not in the archive of raw records yet. Cards without an address stay.

    The archive gives one column, made distinct first: that combines before the shuffle, so a job
    archived in every run stays one row, and the join reuses the distinct's partitioning.
    """
    seen = archive.select(F.col("job_identity.job_id_raw").alias("_seen")).distinct()
    job = hash_content(F.col("job_url"))
    return cards.join(seen, job == F.col("_seen"), "left_anti")


def limit_listings(cards: DataFrame, n: int, order: Sequence[str] = ("page", "position")):
    """First ``n`` cards that have an address, in page order."""
    return cards.filter(~is_blank(F.col("job_url"))).orderBy(*order).limit(n)


def company_targets(cards: DataFrame, url: str = "company_url") -> DataFrame:
    """Each company address once."""
    return cards.filter(~is_blank(F.col(url))).select(url).distinct()


def dedup_companies(companies: DataFrame) -> DataFrame:
    """One record per company: the first one seen, with first and last time over all runs. Records
    without an id all stay."""
    c = F.col
    named = companies.withColumn("_id", c("company_identity.company_id_hash"))
    order = [
        c("timestamps.first_seen"), c("company_identity.company_url"), c("company_identity.company_name_raw")
    ]
    spans = {"_first": F.min("timestamps.first_seen"), "_last": F.max("timestamps.last_seen")}
    merged = winning_rows(named.filter("_id is not null"), ["_id"], order, spans)
    seen = F.struct(c("_first").alias("first_seen"), c("_last").alias("last_seen"))
    merged = merged.select(
        *[seen.alias(n) if n == "timestamps" else c(n) for n in companies.columns]
    )
    nameless = companies.filter(c("company_identity.company_id_hash").isNull())
    return merged.unionByName(nameless)


def job_company(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Jobs with their company's page fields.

    Companies have one row per id, so the join never multiplies, and one that holds many jobs is split
    by the engine. Jobs without a company take a hash of themselves as key, so they spread.
    """
    job_id = F.col("company_info.company_id_hash")
    hashed = [f.name for f in jobs.schema if not has_map(f.dataType)]
    own_hash = F.concat(F.lit("\0"), F.xxhash64(*hashed).cast("string"))
    keyed = jobs.withColumn("_company", F.coalesce(job_id, own_hash))
    right = companies.filter("company_identity.company_id_hash is not null").select(
        F.col("company_identity.company_id_hash").alias("_company"),
        F.col("company_identity.company_name_raw").alias("company_name"),
        F.col("company_page_raw.company_industry_raw").alias("company_industry"),
        F.col("company_page_raw.company_size_raw").alias("company_size"),
    )
    return keyed.join(right, "_company", "left").drop("_company")


def change_history(df: DataFrame, key: str, ts: str, content_hash: str) -> DataFrame:
    """Runs of each job with the previous content hash and what happened: ``new``, ``changed``
    or ``same``. Rows without a key are no job's history: each is ``new``.

    First one row per job and run is made (the smallest hash, should a run hold several). After
    that a window holds at most as many rows as there are runs.
    """
    named = df.filter(F.col(key).isNotNull())
    per_run = named.groupBy(key, ts).agg(F.min(content_hash).alias(content_hash))
    w = Window.partitionBy(key).orderBy(ts)
    seen = per_run.withColumns(
        {"previous_hash": F.lag(content_hash).over(w), "run_no": F.row_number().over(w)}
    )
    nameless = df.filter(F.col(key).isNull()).select(
        key,
        ts,
        content_hash,
        F.lit(None).cast("string").alias("previous_hash"),
        F.lit(1).alias("run_no"),
        F.lit("new").alias("change"),
    )
    judged = seen.withColumn(
        "change",
        F.when(F.col("run_no") == 1, "new")
        .when(F.col("previous_hash").eqNullSafe(F.col(content_hash)), "same")
        .otherwise("changed"),
    )
    return judged.unionByName(nameless)
