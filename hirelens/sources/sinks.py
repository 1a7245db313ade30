"""Writing records, datasets and reports.

Files of a run go below ``keyword_slug=…/run_ts=…``, so reading one run or one search prunes to it.
Writing a run again replaces it, and a write that breaks off leaves what was there, see ``runs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.functions.text import keyword_slug
from hirelens.sources import runs

LIST_COLUMNS = [
    f.name
    for f in schemas.PARSED_JOB
    if f.dataType.typeName() == "array"
]


SEARCH_RUN = ("keyword_slug", "run_ts")  # what names a run of a search
DATASET_RUN = ("dataset_version", "run_ts")
RUN = ("run_ts",)


def write_raw_jobs(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Raw job records by search keyword and run. ``fmt="parquet"`` lets later reads take single
    nested fields."""
    meta = F.col("scrape_metadata")
    named = {"keyword_slug": keyword_slug(meta["search_keyword"]), "run_ts": meta["scrape_timestamp"]}
    runs.write_runs(df.withColumns(named), path, SEARCH_RUN, fmt)


def write_raw_companies(df: DataFrame, path: str, keywords: str, fmt: str = "json") -> None:
    """Raw company records; without records no run appears."""
    named = {"keyword_slug": keyword_slug(F.lit(keywords)), "run_ts": F.col("timestamps.last_seen")}
    runs.write_runs(df.withColumns(named), path, SEARCH_RUN, fmt)


def write_raw_listings(cards: DataFrame, path: str, run_ts: str = "") -> None:
    """Listing cards of a run before their pages are looked at. Cards do not tell their run; those
    written without ``run_ts`` are one run."""
    named = schemas.conform(cards, schemas.CARD).withColumn("run_ts", F.lit(run_ts))
    runs.write_runs(named, path, RUN, "json", run=[run_ts])


def write_parsed(df: DataFrame, path: str) -> None:
    """Parsed postings as JSON by the run they were collected in."""
    runs.write_runs(df.withColumn("run_ts", F.col("scrape_timestamp")), path, RUN, "json")


def typed_lists(df: DataFrame) -> DataFrame:
    """List columns as ``array<string>`` whatever they came as (JSON text included)."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.from_json(F.col(c), "array<string>")
            if types[c] == "string"
            else F.col(c).cast("array<string>")
            for c in LIST_COLUMNS
            if c in types
        }
    )


def write_csv_flat(df: DataFrame, path: str) -> None:
    """CSV without the list columns, which it cannot hold. Line breaks, quotes and outer spaces stay."""
    df.drop(*LIST_COLUMNS).write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_dataset(df: DataFrame, path: str, run_ts: str, also_csv: bool = True) -> dict[str, str]:
    """Versioned Parquet, and flat CSV of this run; the names of what was written.

    The rows are computed once: the CSV is made from the version just written. Writing a run again
    replaces that run and no other. ``parquet_latest`` is the folder of the run just written, which
    nobody writes to again; ``archive.scan_latest`` finds the newest one of ``parquet``.
    """
    versions = f"{path}/versions"
    typed = typed_lists(df).withColumn("run_ts", F.lit(run_ts))
    latest = runs.write_attempt(typed, versions, DATASET_RUN, "parquet")
    paths = {"parquet": versions, "parquet_latest": latest}
    if also_csv:
        written = df.sparkSession.read.schema(typed.schema).parquet(latest).drop("run_ts")
        paths["csv"] = f"{path}/csv/run_ts={run_ts}/{latest.rsplit('/', 1)[1]}"
        write_csv_flat(written, paths["csv"])
    runs.commit(df.sparkSession, versions, latest, DATASET_RUN, "parquet")
    return paths


def write_report(report: DataFrame, path: str) -> None:
    """Reports as JSON by their time; the report of a time is replaced by a later one."""
    named = report.withColumn("run_ts", F.col("timestamp"))
    runs.write_runs(named, path, RUN, "json")
