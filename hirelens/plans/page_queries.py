"""Queries over pages: elements, selectors, extraction, cards, raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.text import company_about_url, strip_query
from hirelens.operators import collection, extract, html, records
from hirelens.operators.history import dedup_companies, first_rows, job_company
from hirelens.operators.quality import quality_level
from hirelens.plans import inputs
from hirelens.sources import archive

c = F.col

# selectors for the markup that the saved pages really have
PAGE_SELECTORS = [
    ("div", "class", "missing"),
    ("div", "class", "ad"),
    ("h1", "class", "headline"),
]


def scan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = archive.scan_pages(spark, f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").alias("chars"))


def html_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Head-level elements of the saved pages: tag counts and the title text."""
    elements = html.html_elements(inputs.table(spark, sf_dir, "pages"))
    return elements.groupBy("page_id").agg(
        F.count_if(c("tag") == "p").alias("paragraphs"),
        F.count_if(c("tag") == "a").alias("links"),
        F.count_if(c("tag") == "script").alias("scripts"),
        F.max(F.when(c("tag") == "title", c("text"))).alias("title"),
        F.max(F.when(c("attrs")["class"] == "ad", c("text"))).alias("ad"),
    )


def selector_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "pages")
    parsed = html.parse_pages(pages, ["page_id"], tags=["div", "h1"], attrs=[], markup=False)
    return extract.selector_cascade(parsed, "ad", PAGE_SELECTORS, ["page_id"])


def longest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of the longest list item of each page."""
    pages = inputs.table(spark, sf_dir, "pages")
    parsed = html.parse_pages(pages, ["page_id"], tags=[], attrs=[], bare_tags=["li"], markup=False)
    found = parsed.select("page_id", extract.longest_text("li", 0).alias("x"))
    return found.select("page_id", c("x.value").alias("longest"))


def job_page_fields(*columns):
    """Query: some of the fields of every job page."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = extract.extract_job_pages(inputs.job_pages(spark, sf_dir), ["doc_id"])
        return found.select("doc_id", *[make() if callable(make) else make for make in columns])

    return run


def field(name: str, value):
    """A column of the parsed job pages, computed alone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        parsed = extract.parse_job_pages(inputs.job_pages(spark, sf_dir), ["doc_id"])
        return parsed.select("doc_id", value().alias(name))

    return run


def extract_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White space at line ends is gone from extracted text, so words and lengths are compared."""
    found = field("d", extract.description)(spark, sf_dir)
    return found.select(
        "doc_id",
        F.md5(F.regexp_replace("d.value", r"\s+", "")).alias("text_hash"),
        c("d.method").alias("method"),
    )


def extract_description_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = field("html", extract.description_html)(spark, sf_dir)
    return found.select("doc_id", F.md5("html").alias("html_hash"))


def extract_insight(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = field("i", extract.insight)(spark, sf_dir)
    return found.select("doc_id", c("i.text").alias("text"), F.length("i.html").alias("html_chars"))


def criteria_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = field("m", extract.criteria_map)(spark, sf_dir)
    entries = F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return found.select("doc_id", F.array_join(entries, ";").alias("criteria"))


def every_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that between them hit every selector of every field: value, selector and markup."""
    found = extract.extract_job_pages(inputs.selected_pages(spark, sf_dir), ["doc_id"])
    status = [n for n, _ in extract.STATUS_FIELDS]
    return found.select(
        "doc_id",
        "description",
        "description_extract_method",
        F.md5("description_html").alias("description_html_hash"),
        "location_from_panel_raw",
        "job_insight_section_raw_text",
        F.md5("job_insight_section_raw_html").alias("insight_html_hash"),
        *[c for n in status for c in (f"{n}_raw", f"{n}_status", f"{n}_method")],
        *[name for name, _ in rules.CRITERIA_COLUMNS],
        "selector_hits",
    )


def every_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company pages with all facts, and each about selector on some."""
    found = extract.extract_company_pages(inputs.full_company_pages(spark, sf_dir), ["s_suppkey"])
    facts = [f"company_{name}_raw" for _, name in rules.COMPANY_FACTS]
    return found.select("s_suppkey", "company_about_raw_text", "company_about_method", *facts)


def company_about(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract_company_pages(inputs.company_pages(spark, sf_dir), ["s_suppkey"])
    return found.select(
        "s_suppkey",
        "company_about_raw_text",
        "company_about_raw_html",
        "company_about_method",
    )


def company_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract_company_pages(inputs.company_pages(spark, sf_dir), ["s_suppkey"])
    return found.select("s_suppkey", *[f"company_{name}_raw" for _, name in rules.COMPANY_FACTS])


def _collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = inputs.postings(spark, sf_dir).select(
        "doc_id", "job_url", "company_url", "raw_title", "company", "raw_location",
        "date_posted_raw", "scrape_timestamp",
        F.lit(None).cast("string").alias("date_posted_attr"),
    )
    extracted = extract.extract_job_pages(inputs.job_pages(spark, sf_dir))
    return records.fetched(cards, extracted)


def gate_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collected(spark, sf_dir).transform(records.gate_success).select("doc_id", "job_url")


def failed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.reject_rows(_collected(spark, sf_dir), c("scrape_timestamp"))


def build_raw_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards joined with their pages, gated, nested; then some leaves of every section."""
    kept = _collected(spark, sf_dir).transform(records.gate_success)
    raw = records.build_raw_job(kept, c("scrape_timestamp"), "Data Scientist", "worldwide", "agent")
    return raw.select(
        "scraper_version",
        "raw_schema_version",
        "scrape_metadata.search_keyword",
        "scrape_metadata.scrape_timestamp",
        "job_identity.job_id_raw",
        "job_identity.job_url",
        "job_card_raw.title_raw",
        "job_page_raw.salary_raw_text",
        "job_page_raw.salary_status",
        "job_page_raw.employment_type_raw",
        "company_info.company_id_hash",
        "quality_tracking.extraction_quality",
        "quality_tracking.retry_count",
        F.size("quality_tracking.status_code_history").alias("status_codes"),
        (c("hashing.job_post_id_hash") == c("job_identity.job_id_raw")).alias("same_id"),
        c("hashing.job_description_content_hash").isNotNull().alias("has_hash"),
    )


def build_raw_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_companies(spark, sf_dir).select(
        "company_identity.*",
        "company_page_raw.company_industry_raw",
        "company_page_raw.company_size_raw",
        "company_page_raw.company_website_raw",
        c("hashing.company_about_content_hash").alias("about_hash"),
        c("timestamps.first_seen").alias("first_seen"),
        c("quality_tracking.selector_hits").alias("selector_hits"),
    )


def raw_to_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = records.raw_to_columns(inputs.raw_jobs(spark, sf_dir))
    return flat.withColumn("description", F.md5("description"))


def quality_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    critical = [F.when(c("doc_id") % 29 != 0, c("description")), c("salary_raw"), c("applicant_count_raw")]
    return inputs.postings(spark, sf_dir).select("doc_id", quality_level(*critical).alias("level"))


def joined_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = inputs.raw_companies(spark, sf_dir).transform(dedup_companies)
    return job_company(inputs.raw_jobs(spark, sf_dir), companies).select(
        "job_identity.job_url", "scrape_metadata.scrape_timestamp",
        "company_name", "company_industry", "company_size",
    )


def _new_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of all listing pages but for jobs the first run has."""
    seen = inputs.raw_jobs(spark, sf_dir).filter(
        c("scrape_metadata.scrape_timestamp") < "2026-02-17"
    )
    return collection.new_cards(inputs.listing_pages(spark, sf_dir), seen)


def collect_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages to raw records: cards, archive check, first of each, job pages, gate."""
    pages = inputs.job_pages(spark, sf_dir).withColumn("url", strip_query(c("url")))
    addressed = first_rows(pages, ["url"], [c("doc_id")]).select("url", "html")
    raw = collection.collect_jobs(
        _new_cards(spark, sf_dir), addressed, F.lit("2026-02-21T00:00:00"), "any"
    )
    return raw.select(
        "job_identity.*",
        "job_card_raw.title_raw",
        "job_page_raw.applicant_count_raw",
        "quality_tracking.extraction_quality",
        "quality_tracking.selector_hits",
        "scrape_metadata.scrape_timestamp",
    )


def collect_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.company_pages(spark, sf_dir).select(
        company_about_url(c("url")).alias("url"), "html"
    )
    raw = collection.collect_companies(
        inputs.cards(spark, sf_dir), pages, F.lit("2026-02-21T00:00:00")
    )
    return raw.select("company_identity.*", "company_page_raw.company_size_raw", "timestamps.first_seen")


QUERIES = {
    "collect_jobs": collect_jobs,
    "collect_companies": collect_companies,
    "scan_pages": scan_pages,
    "html_elements": html_elements,
    "selector_cascade": selector_cascade,
    "longest_text": longest_text,
    "extract_description": extract_description,
    "extract_description_html": extract_description_html,
    "extract_location_panel": field(
        "location", lambda: extract.cascade(rules.LOCATION_SELECTORS)["value"]
    ),
    "extract_insight": extract_insight,
    "every_selector": every_selector,
    "every_fact": every_fact,
    "extract_status_fields": job_page_fields(
        "salary_raw", "salary_status", "salary_method", "applicant_count_raw",
        "applicant_count_status", "applicant_count_method", "easy_apply_flag_status",
        "remote_label_status", "posted_by_status",
    ),
    "extract_criteria_map": criteria_map,
    "extract_criteria_cols": job_page_fields(
        "employment_type_raw", "seniority_raw", "industry_raw", "job_function_raw"
    ),
    "extract_json_ld": field("json_ld", extract.json_ld),
    "extract_job_json": field("job_json", extract.job_json),
    "selector_hits": job_page_fields("selector_hits", "success", "error"),
    "extract_company_about": company_about,
    "extract_company_facts": company_facts,
    "cards_from_pages": lambda s, d: extract.cards_from_pages(inputs.listing_pages(s, d)),
    "hash_company_about": lambda s, d: company_about(s, d).select(
        "s_suppkey", records.hash_content(c("company_about_raw_text")).alias("hash")
    ),
    "gate_success": gate_success,
    "failed_pages": failed_pages,
    "build_raw_job": build_raw_job,
    "build_raw_company": build_raw_company,
    "raw_to_columns": raw_to_columns,
    "quality_level": quality_levels,
    "job_company": joined_companies,
}
