"""Queries over the archive: reading back what was written, history, quality and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.functions.text import hash_content
from hirelens.operators import corpus, history, postings, quality
from hirelens.plans import inputs
from hirelens.session import new_path
from hirelens.sources import archive, run_state, sinks

c = F.col
NOW = "2026-02-21T00:00:00"


def _archived(spark: SparkSession, sf_dir: str, fmt: str = "json") -> str:
    path = new_path(spark, "raw-jobs")
    sinks.write_raw_jobs(inputs.raw_jobs(spark, sf_dir), path, fmt)
    return path


def scan_raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = archive.scan_raw_jobs(spark, _archived(spark, sf_dir))
    return raw.select(
        "job_identity.*",
        "job_card_raw.title_raw",
        "scrape_metadata.scrape_timestamp",
        "quality_tracking.extraction_quality",
        F.md5("job_page_raw.job_description_raw_text").alias("description"),
    )


def write_raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition folder, from a Parquet archive."""
    path = _archived(spark, sf_dir, "parquet")
    written = spark.read.parquet(path)
    return written.groupBy("keyword_slug", c("run_ts").cast("string").alias("run_ts")).agg(
        F.count("job_identity.job_id_raw").alias("n")
    )


def write_raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "raw-companies")
    sinks.write_raw_companies(inputs.raw_companies(spark, sf_dir), path, "Data Scientist")
    back = archive.scan_raw_companies(spark, path)
    return back.groupBy("timestamps.last_seen").agg(
        F.count(F.lit(1)).alias("n"), F.max("company_identity.company_name_raw").alias("last_name")
    )


def write_raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "listings")
    sinks.write_raw_listings(inputs.postings(spark, sf_dir), path)
    return archive.scan_listings(spark, path)


def write_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "parsed")
    sinks.write_parsed(inputs.parsed(spark, sf_dir).drop("text"), path)
    back = archive.scan_parsed(spark, path)
    return back.select(
        "job_url", "scrape_timestamp", "role_type",
        F.array_join("skills_required", "|").alias("skills_required"),
        c("date_posted_normalized").cast("string").alias("day"),
    )


def _parsed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.parsed(spark, sf_dir).select(*schemas.PARSED_JOB.names)


def write_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and list cells in the versioned and in the latest copy."""
    paths = sinks.write_dataset(_parsed_only(spark, sf_dir), new_path(spark, "dataset"), NOW)
    versions = archive.scan_dataset(spark, paths["parquet"]).drop("run_ts")
    latest = archive.scan_latest(spark, paths["parquet"]).select(versions.columns)
    both = versions.withColumn("copy", F.lit("versions")).union(
        latest.withColumn("copy", F.lit("latest"))
    )
    return both.groupBy("copy", "dataset_version").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size("skills_required")).alias("required"),
        F.sum(F.size("title_keywords")).alias("keywords"),
    )


def write_csv_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    sinks.write_csv_flat(_parsed_only(spark, sf_dir), path)
    back = spark.read.csv(
        path,
        header=True,
        escape='"',
        multiLine=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return back.select(
        "job_id", "job_url", "raw_title", "city", "region", "work_mode", "scrape_timestamp",
        F.md5("job_description_raw").alias("description"),
    )


def typed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists that came as JSON text."""
    df = inputs.parsed(spark, sf_dir).withColumn("skills_required", F.to_json("skills_required"))
    typed = sinks.typed_lists(df)
    return typed.select(
        "doc_id",
        F.size("skills_required").alias("required"),
        F.array_join("skills_required", "|").alias("skills"),
    )


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = inputs.postings(spark, sf_dir).transform(postings.parse_rejects)
    check = quality.schema_report(_parsed_only(spark, sf_dir))
    return quality.report(rejects, check, F.lit(NOW))


def write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "report")
    report = _report(spark, sf_dir)
    sinks.write_report(report, path)
    back = archive.scan_reports(spark, path, report.schema)
    return back.select(
        "timestamp",
        "schema_version",
        "dataset_version",
        "scrape_report.total_failures",
        F.try_element_at("scrape_report.failure_reasons", F.lit("no description")).alias("thin"),
        "schema_validation.valid",
        "schema_validation.row_count",
    )


def skip_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of the last run whose job no earlier run has."""
    archived = inputs.raw_jobs(spark, sf_dir).filter(
        c("scrape_metadata.scrape_timestamp") < "2026-02-20"
    )
    cards = inputs.cards(spark, sf_dir).filter(c("scrape_timestamp") >= "2026-02-20")
    return history.skip_seen(cards, archived).select("doc_id", "job_url")


def dedup_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records, texts included."""
    kept = inputs.cards(spark, sf_dir).transform(history.dedup_jobs)
    return kept.select("doc_id", "job_id_raw", "page", "position", "raw_title", F.md5("text").alias("text"))


def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records, texts included; every 23rd has no id and stays."""
    cards = inputs.cards(spark, sf_dir)
    cards = cards.withColumn("job_id_raw", F.when(c("doc_id") % 23 != 22, c("job_id_raw")))
    kept = history.dedup_by_id(cards, "job_id_raw", "scrape_timestamp", "doc_id")
    return kept.select("doc_id", "job_id_raw", "scrape_timestamp", "raw_title", F.md5("text").alias("text"))


def limit_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 cards that have an address."""
    cards = inputs.cards(spark, sf_dir).withColumn(
        "job_url", F.when(c("doc_id") % 3 != 0, c("job_url"))
    )
    return history.limit_listings(cards, 25).select("page", "position", "job_url")


def dedup_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = inputs.raw_companies(spark, sf_dir).transform(history.dedup_companies)
    return merged.select(
        "company_identity.company_url", "company_identity.company_name_raw", "timestamps.*"
    )


def company_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.company_targets(inputs.cards(spark, sf_dir))


def _hashed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of the same job in other runs have other texts, but for every third job."""
    cards = inputs.cards(spark, sf_dir).withColumn(
        "description", F.when(c("doc_id") % 3 == 0, "fixed").otherwise(c("text"))
    )
    return cards.withColumn("content_hash", hash_content(c("description")))


def change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = _hashed_cards(spark, sf_dir)
    return history.change_history(hashed, "job_url", "scrape_timestamp", "content_hash")


def _runs(cards: DataFrame) -> list[str]:
    return sorted(r[0] for r in cards.select("scrape_timestamp").distinct().collect())  # one per run


def change_history_by_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, run by run: each run meets the state of the one before, never the archive."""
    hashed, path, told = _hashed_cards(spark, sf_dir), new_path(spark, "state"), []
    for run in _runs(hashed):
        new = hashed.filter(c("scrape_timestamp") == run)
        told.append(run_state.advance(new, path, run, "job_url", "content_hash"))
    return reduce(DataFrame.unionByName, told).withColumnRenamed("run", "scrape_timestamp")


def skip_seen_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of each run that no earlier run has, by the state that the runs carry on."""
    cards, path, left = _hashed_cards(spark, sf_dir), new_path(spark, "state"), []
    for run in _runs(cards):
        new = cards.filter(c("scrape_timestamp") == run)
        left.append(run_state.unseen(new, path, "job_id_raw", run).select("doc_id", "scrape_timestamp"))
        run_state.advance(new, path, run, "job_id_raw", "content_hash")
    return reduce(DataFrame.unionByName, left)


def quality_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_jobs(spark, sf_dir)
    return quality.quality_distribution(raw, c("quality_tracking.extraction_quality"))


def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.field_coverage(inputs.raw_jobs(spark, sf_dir)).select("field", "non_null", "rows", "pct")


def head_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 15 fields of the coverage report, and the sections of the first record."""
    raw = inputs.raw_jobs(spark, sf_dir)
    fields = quality.field_coverage(raw).filter("position < 15").select(
        F.lit("coverage").alias("part"), "position", "field", "non_null"
    )
    first = quality.first_row(raw, [c("scrape_metadata.scrape_timestamp"), c("job_identity.job_url")])
    return fields.unionByName(first.select(F.lit("first row").alias("part"), "*"))


def schema_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaf fields of job and company records and in how many records each is set."""
    archives = {"job": inputs.raw_jobs(spark, sf_dir), "company": inputs.raw_companies(spark, sf_dir)}
    parts = [
        quality.field_coverage(raw, name_has=("",)).select(
            F.lit(record).alias("record"), "position", c("field").alias("path"), "non_null"
        )
        for record, raw in archives.items()
    ]
    return parts[0].unionByName(parts[1])


def failure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stand in for failures, their type for the reason."""
    events = inputs.table(spark, sf_dir, "events").select(c("event_type").alias("reason"))
    return quality.failure_report(events)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stand in for a run history: a day is a run, an error a failure."""
    events = inputs.table(spark, sf_dir, "events").withColumn("run", F.to_date("ts").cast("string"))
    kept, failed = events.filter("event_type != 'error'"), events.filter("event_type = 'error'")
    return quality.run_summary(kept, failed, "run", "run")


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _parsed_only(spark, sf_dir).drop("source").withColumn("extra", F.lit(1)).withColumn(
        "title_keywords", F.when(c("raw_title").isNotNull(), c("title_keywords"))
    )
    return quality.schema_report(df).select(
        "valid",
        F.array_join("missing_columns", "|").alias("missing_columns"),
        F.array_join("extra_columns", "|").alias("extra_columns"),
        F.try_element_at("list_format_issues", F.lit("title_keywords")).alias("bad_keywords"),
        "row_count",
        "schema_version",
    )


def column_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed rows brought to the declared columns: the missing one is null, the extra one gone."""
    df = _parsed_only(spark, sf_dir).drop("source").withColumn("extra", F.lit(1))
    missing, extra = quality.column_sets(df, schemas.PARSED_JOB)
    whole = schemas.conform(df, schemas.PARSED_JOB)
    return whole.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("source").alias("sources"),
        F.lit("|".join(missing)).alias("missing"),
        F.lit("|".join(extra)).alias("extra"),
    )


def schema_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources that name the title differently, brought together."""
    p = inputs.postings(spark, sf_dir)
    one = p.filter("lang = 'en'").select("doc_id", c("raw_title").alias("title"), "job_url")
    two = p.filter("lang != 'en'").select("doc_id", c("raw_title").alias("job_title"), c("job_url").alias("url"))
    names = {"doc_id": ["doc_id"], "title": ["title", "job_title"], "job_url": ["job_url", "url"]}
    return corpus.schema_map(one.unionByName(two, allowMissingColumns=True), names)


def drop_or_fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir)
    out = corpus.drop_or_fill_missing(p, "description", {"raw_title": "untitled", "salary_raw": "none"})
    return out.select("doc_id", "raw_title", "salary_raw", "raw_title_missing", "salary_raw_missing")


QUERIES = {
    f.__name__: f
    for f in (
        scan_raw_jobs, write_raw_jobs, write_raw_companies, write_raw_listings, write_parsed,
        write_dataset, write_csv_flat, typed_lists, write_report, skip_seen, dedup_jobs, dedup_by_id,
        limit_listings, dedup_companies, company_targets, change_history, change_history_by_runs,
        skip_seen_by_state, quality_distribution,
        field_coverage, head_sample, schema_leaves, failure_report, run_summary, schema_report,
        column_sets, schema_map, drop_or_fill_missing,
    )
}
