"""Raw records: listing cards and page fields to nested rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import rules, schemas
from hirelens.functions.text import hash_content, is_blank
from hirelens.operators.quality import quality_level

# FIXED VALUES: record column <- column of the extracted page (unlisted ones have equal names)
_PAGE_SOURCE = {
    "job_description_raw_text": "description",
    "job_description_raw_html": "description_html",
    "salary_raw_text": "salary_raw",
}
_COMPANY_SOURCE = {"company_founded_year": "company_founded_raw"}


def _section(schema: T.StructType, name: str, **values: Column) -> Column:
    """Struct of a section's declared fields; those without a value are null."""
    fields = schema[name].dataType.fields
    return F.struct(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    ).alias(name)


def filter_has_url(cards: DataFrame, url: str = "job_url") -> DataFrame:
    return cards.filter(~is_blank(F.col(url)))


def fetched(cards: DataFrame, extracted: DataFrame, url: str = "url") -> DataFrame:
    """Cards with the fields of their job page. A card whose page is missing counts as not
    fetched. Pages have one row per address, so this equi-join never multiplies rows."""
    pages = extracted.withColumnRenamed(url, "job_url")
    joined = filter_has_url(cards).join(pages, "job_url", "left")
    return joined.withColumns(
        {
            "success": F.coalesce("success", F.lit(False)),
            "error": F.when(F.col("success"), F.lit(None)).otherwise(
                F.coalesce("error", F.lit(rules.FETCH_FAILED))
            ),
        }
    )


def gate_success(df: DataFrame) -> DataFrame:
    return df.filter("success")


def reject_rows(df: DataFrame, run_ts: Column) -> DataFrame:
    """What ``gate_success`` drops, with the reason."""
    lost = df.filter("NOT success").withColumns({"reason": F.col("error"), "timestamp": run_ts})
    return schemas.conform(lost, schemas.REJECT)


def build_raw_job(
    df: DataFrame,
    run_ts: Column,
    search_keyword: str = "",
    search_location: str = "",
    user_agent: str | None = None,
) -> DataFrame:
    """Nested raw job records from successfully extracted cards."""
    schema = schemas.RAW_JOB
    page_fields = schema["job_page_raw"].dataType.names
    sources = {f: _PAGE_SOURCE.get(f, f) for f in page_fields}
    page = {f: F.col(c) for f, c in sources.items() if c in df.columns}
    hits = F.col("selector_hits") if "selector_hits" in df.columns else F.lit(None)
    job_id = hash_content(F.col("job_url"))
    company_url = F.nullif("company_url", F.lit(""))
    return df.select(
        F.lit(rules.SCRAPER_VERSION).alias("scraper_version"),
        F.lit(rules.RAW_VERSION).alias("raw_schema_version"),
        _section(
            schema,
            "scrape_metadata",
            search_keyword=F.lit(search_keyword),
            search_location=F.lit(search_location),
            scrape_timestamp=run_ts,
            user_agent_used=F.lit(user_agent),
        ),
        _section(schema, "job_identity", job_id_raw=job_id, job_url=F.col("job_url")),
        _section(
            schema,
            "job_card_raw",
            title_raw=F.col("raw_title"),
            company_raw=F.col("company"),
            location_raw=F.col("raw_location"),
            date_posted_raw=F.col("date_posted_raw"),
            date_posted_attr=F.col("date_posted_attr"),
        ),
        _section(schema, "job_page_raw", **page),
        _section(
            schema, "company_info", company_url=company_url, company_id_hash=hash_content(company_url)
        ),
        _section(
            schema,
            "quality_tracking",
            extraction_quality=quality_level(
                F.col("description"), F.col("salary_raw"), F.col("applicant_count_raw")
            ),
            selector_hits=hits,
            status_code_history=F.array(),
            retry_count=F.lit(0),
        ),
        _section(
            schema,
            "hashing",
            job_description_content_hash=hash_content(F.col("description")),
            job_post_id_hash=job_id,
        ),
    )


def build_raw_company(df: DataFrame, run_ts: Column) -> DataFrame:
    """Nested raw company records from ``company_url``, ``company_name`` and the page's fields."""
    schema = schemas.RAW_COMPANY
    page_fields = schema["company_page_raw"].dataType.names
    sources = {f: _COMPANY_SOURCE.get(f, f) for f in page_fields}
    page = {f: F.col(c) for f, c in sources.items() if c in df.columns}
    company_id = hash_content(F.col("company_url"))
    about_hash = hash_content(F.col("company_about_raw_text"))
    found = [F.col(c).isNotNull().cast("int") for c in sources.values() if c in df.columns]
    return df.select(
        F.lit(rules.SCRAPER_VERSION).alias("scraper_version"),
        F.lit(rules.RAW_VERSION).alias("raw_schema_version"),
        _section(
            schema,
            "company_identity",
            company_id_hash=company_id,
            company_name_raw=F.col("company_name"),
            company_url=F.col("company_url"),
        ),
        _section(schema, "company_page_raw", **page),
        _section(
            schema,
            "hashing",
            company_content_hash=about_hash,
            company_about_content_hash=about_hash,
            company_id_hash=company_id,
        ),
        _section(schema, "timestamps", first_seen=run_ts, last_seen=run_ts),
        _section(schema, "quality_tracking", retry_count=F.lit(0), selector_hits=sum(found, F.lit(0))),
    )


def raw_to_columns(raw: DataFrame) -> DataFrame:
    """The fields parsing needs, flat. From Parquet only these leaves are read."""
    return raw.select(
        F.col("job_card_raw.title_raw").alias("raw_title"),
        F.col("job_card_raw.company_raw").alias("company"),
        F.col("job_card_raw.location_raw").alias("raw_location"),
        F.col("job_card_raw.date_posted_raw").alias("date_posted_raw"),
        F.col("job_identity.job_url").alias("job_url"),
        F.col("job_page_raw.job_description_raw_text").alias("description"),
        F.col("job_page_raw.employment_type_raw").alias("employment_type_raw"),
        F.col("scrape_metadata.scrape_timestamp").alias("scrape_timestamp"),
        F.col("quality_tracking.extraction_quality").alias("extraction_quality"),
    )
