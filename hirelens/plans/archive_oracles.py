"""SQL for the queries of ``archive_queries``."""

from __future__ import annotations

from hirelens import rules, schemas
from hirelens.plans.archive_queries import NOW
from hirelens.plans.oracle_base import joined, over_parsed, strip, with_postings
from hirelens.plans.page_oracles import _COMPANY_URL, _QUALITY, _SUPPLIERS, _URL

_LEVEL = _QUALITY.format("description", "salary_raw", "applicant_count_raw")
_CARDS = (
    f"cards AS (SELECT * REPLACE ({_URL} AS job_url), sha256({_URL}) AS job_id_raw,"
    " doc_id // 25 AS page, CAST(doc_id % 25 AS INTEGER) AS position FROM postings)"
)
# leaf path -> SQL of its value in the postings; every other leaf is null
_LEAVES = {
    "scraper_version": "1",
    "raw_schema_version": "1",
    "scrape_metadata.search_keyword": "1",
    "scrape_metadata.search_location": "1",
    "scrape_metadata.scrape_timestamp": "1",
    "job_identity.job_id_raw": "1",
    "job_identity.job_url": "1",
    "job_card_raw.title_raw": "raw_title",
    "job_card_raw.company_raw": "company",
    "job_card_raw.location_raw": "raw_location",
    "job_card_raw.date_posted_raw": "date_posted_raw",
    "job_page_raw.job_description_raw_text": "description",
    "job_page_raw.salary_raw_text": "salary_raw",
    "job_page_raw.applicant_count_raw": "applicant_count_raw",
    "job_page_raw.employment_type_raw": "employment_type_raw",
    "company_info.company_url": "1",
    "company_info.company_id_hash": "1",
    "quality_tracking.extraction_quality": "1",
    "quality_tracking.status_code_history": "1",
    "quality_tracking.retry_count": "1",
    "hashing.job_description_content_hash": "description",
    "hashing.job_post_id_hash": "1",
}
_PATHS = schemas.leaf_paths(schemas.RAW_JOB)


# every company record has all other leaves, in each of three runs
_NO_COMPANY_LEAVES = {
    "company_page_raw.company_specialties_raw",
    "company_page_raw.company_founded_year",
    "company_page_raw.company_employees_count_raw",
    "quality_tracking.extraction_quality",
}


def _counted(keep, limit: int | None = None) -> str:
    paths = [p for p in _PATHS if keep(p)][:limit]
    counts = ", ".join(f"count({_LEAVES.get(p, 'NULL')}) AS c{i}" for i, p in enumerate(paths))
    return f"counted AS (SELECT count(*) AS n, {counts} FROM postings)"


def _coverage_rows(columns: str, keep, limit: int | None = None) -> str:
    paths = [p for p in _PATHS if keep(p)][:limit]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{p}' AS field, c{i} AS non_null, n AS rows FROM counted"
        for i, p in enumerate(paths)
    )
    return f"SELECT {columns} FROM ({rows})"


def _coverage(columns: str, keep) -> str:
    return with_postings(_coverage_rows(columns, keep), _counted(keep))


def _first_row() -> str:
    """Leaves that the first posting sets, by section of the record."""
    parts = []
    for i, f in enumerate(schemas.RAW_JOB.names[:10]):
        own = [_LEAVES.get(p, "NULL") for p in _PATHS if p == f or p.startswith(f + ".")]
        total = " + ".join(f"CAST({v} IS NOT NULL AS BIGINT)" for v in own)
        parts.append(f"SELECT {i} AS position, '{f}' AS field, {total} AS non_null FROM first")
    return " UNION ALL ".join(parts)


def _raw_or_hash(path: str) -> bool:
    return "raw" in path or "hash" in path


_THIN_COUNT = f"(SELECT count(*) FROM postings WHERE length({strip('description')}) < 50)"

ORACLES = {
    "scan_raw_jobs": with_postings(
        f"SELECT sha256({_URL}) AS job_id_raw, {_URL} AS job_url, raw_title AS title_raw,"
        f" scrape_timestamp, {_LEVEL} AS extraction_quality, md5(description) AS description"
        " FROM postings"
    ),
    "write_raw_jobs": with_postings(
        "SELECT 'data_scientist_ml' AS keyword_slug, scrape_timestamp AS run_ts, count(*) AS n"
        " FROM postings GROUP BY ALL"
    ),
    "write_raw_companies": "SELECT '2026-02-' || day || 'T20:31:07' AS last_seen, count(*) AS n,"
    f" max(s_name) AS last_name FROM {_SUPPLIERS} CROSS JOIN (VALUES (16), (18), (20)) d(day) GROUP BY ALL",
    "write_raw_listings": with_postings(
        "SELECT raw_title, company, raw_location, date_posted_raw, CAST(NULL AS VARCHAR)"
        " AS date_posted_attr, job_url, company_url FROM postings"
    ),
    "write_parsed": over_parsed(
        f"SELECT job_url, scrape_timestamp, role_type, {joined('req')} AS skills_required,"
        " date_posted_normalized AS day FROM parsed"
    ),
    "write_dataset": over_parsed(
        f"SELECT copy, '{rules.DATASET_VERSION}' AS dataset_version, count(*) AS n,"
        " CAST(sum(len(req)) AS BIGINT) AS required, CAST(sum(CASE WHEN title_keywords = '' THEN 0 ELSE"
        " len(string_split(title_keywords, '|')) END) AS BIGINT) AS keywords"
        " FROM parsed CROSS JOIN (VALUES ('versions'), ('latest')) c(copy) GROUP BY ALL"
    ),
    "write_csv_flat": over_parsed(
        "SELECT job_id, job_url, raw_title, city, region, work_mode, scrape_timestamp, md5(description)"
        " AS description FROM parsed"
    ),
    "typed_lists": over_parsed(
        f"SELECT doc_id, CAST(len(req) AS INTEGER) AS required, {joined('req')} AS skills FROM parsed"
    ),
    "write_report": over_parsed(
        f"SELECT '{NOW}' AS timestamp, '{rules.PARSED_SCHEMA_VERSION}' AS schema_version,"
        f" '{rules.DATASET_VERSION}' AS dataset_version, (SELECT count(*) FROM postings) - count(*)"
        f" AS total_failures, {_THIN_COUNT} AS thin, true AS valid, count(*) AS row_count FROM parsed"
    ),
    "skip_seen": with_postings(
        "SELECT doc_id, job_url FROM cards c WHERE scrape_timestamp >= '2026-02-20' AND NOT EXISTS"
        " (SELECT 1 FROM cards a WHERE a.job_id_raw = c.job_id_raw AND a.scrape_timestamp < '2026-02-20')",
        _CARDS,
    ),
    "dedup_jobs": with_postings(
        "SELECT doc_id, job_id_raw, page, position, raw_title, md5(text) AS text FROM cards QUALIFY row_number() OVER"
        " (PARTITION BY job_id_raw ORDER BY page, position) = 1",
        _CARDS,
    ),
    "dedup_by_id": with_postings(
        "SELECT doc_id, id AS job_id_raw, scrape_timestamp, raw_title, md5(text) AS text FROM (SELECT *,"
        " CASE WHEN doc_id % 23 <> 22 THEN job_id_raw END AS id FROM cards) QUALIFY id IS NULL OR"
        " row_number() OVER (PARTITION BY id ORDER BY scrape_timestamp DESC, doc_id DESC) = 1",
        _CARDS,
    ),
    "limit_listings": with_postings(
        "SELECT page, position, job_url FROM cards WHERE doc_id % 3 <> 0 ORDER BY page, position LIMIT 25",
        _CARDS,
    ),
    "dedup_companies": "SELECT 'https://co.example/c/' || s_suppkey AS company_url, s_name AS"
    " company_name_raw, '2026-02-16T20:31:07' AS first_seen, '2026-02-20T20:31:07' AS last_seen"
    f" FROM {_SUPPLIERS}",
    "company_targets": with_postings(f"SELECT DISTINCT {_COMPANY_URL} AS company_url FROM postings"),
    "change_history": with_postings(
        "SELECT job_url, scrape_timestamp, content_hash, lag(content_hash) OVER w AS previous_hash,"
        " CAST(row_number() OVER w AS INTEGER) AS run_no, CASE WHEN row_number() OVER w = 1 THEN 'new'"
        " WHEN lag(content_hash) OVER w IS NOT DISTINCT FROM content_hash THEN 'same' ELSE 'changed'"
        " END AS change FROM per_run WINDOW w AS (PARTITION BY job_url ORDER BY scrape_timestamp)",
        _CARDS,
        "per_run AS (SELECT job_url, scrape_timestamp, min(sha256(CASE WHEN doc_id % 3 = 0 THEN 'fixed'"
        f" ELSE nullif({strip('text')}, '') END)) AS content_hash FROM cards GROUP BY ALL)",
    ),
    "skip_seen_by_state": with_postings(
        "SELECT doc_id, scrape_timestamp FROM cards c WHERE NOT EXISTS (SELECT 1 FROM cards a WHERE a.job_id_raw"
        " = c.job_id_raw AND a.scrape_timestamp < c.scrape_timestamp)",
        _CARDS,
    ),
    "quality_distribution": with_postings(
        "SELECT l.level, count(p.level) AS n, round(100.0 * count(p.level) / (SELECT count(*) FROM"
        " postings), 1) AS pct FROM (VALUES ('high'), ('medium'), ('low')) l(level) LEFT JOIN"
        f" (SELECT {_LEVEL} AS level FROM postings) p ON p.level = l.level GROUP BY l.level"
    ),
    "field_coverage": _coverage(
        "field, non_null, rows, round(100.0 * non_null / rows, 1) AS pct", _raw_or_hash
    ),
    "head_sample": with_postings(
        f"SELECT 'coverage' AS part, * FROM ({_coverage_rows('position, field, non_null', _raw_or_hash, 15)})"
        f" UNION ALL SELECT 'first row' AS part, position, field, non_null FROM ({_first_row()})",
        _counted(_raw_or_hash, 15),
        f"first AS (SELECT * FROM postings ORDER BY scrape_timestamp, {_URL} LIMIT 1)",
    ),
    "schema_leaves": with_postings(
        f"SELECT 'job' AS record, * FROM ({_coverage_rows('position, field AS path, non_null', lambda p: True)})"
        " UNION ALL SELECT 'company' AS record, * FROM (" + " UNION ALL ".join(
            f"SELECT {i} AS position, '{p}' AS path, (SELECT {0 if p in _NO_COMPANY_LEAVES else 3} * count(*)"
            f" FROM {_SUPPLIERS}) AS non_null" for i, p in enumerate(schemas.leaf_paths(schemas.RAW_COMPANY))
        ) + ")",
        _counted(lambda p: True),
    ),
    "failure_report": "SELECT event_type AS reason, count(*) AS n, (SELECT count(*) FROM events)"
    " AS total_failures FROM events GROUP BY event_type",
    "run_summary": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_ts,"
    " count(*) FILTER (event_type <> 'error') AS records,"
    " count(*) FILTER (event_type = 'error') AS failures FROM events GROUP BY 1",
    "schema_report": over_parsed(
        "SELECT false AS valid, 'source' AS missing_columns, 'extra' AS extra_columns,"
        " count(*) FILTER (raw_title IS NULL) AS bad_keywords, count(*) AS row_count,"
        f" '{rules.PARSED_SCHEMA_VERSION}' AS schema_version FROM parsed"
    ),
    "column_sets": over_parsed(
        "SELECT count(*) AS n, CAST(0 AS BIGINT) AS sources, 'source' AS missing, 'extra' AS extra"
        " FROM parsed"
    ),
    "schema_map": with_postings("SELECT doc_id, raw_title AS title, job_url FROM postings"),
    "drop_or_fill_missing": with_postings(
        "SELECT doc_id, coalesce(raw_title, 'untitled') AS raw_title, coalesce(salary_raw, 'none')"
        " AS salary_raw, raw_title IS NULL AS raw_title_missing, salary_raw IS NULL AS"
        f" salary_raw_missing FROM postings WHERE length({strip('description')}) >= 50"
    ),
}
ORACLES["change_history_by_runs"] = ORACLES["change_history"]
