"""SQL for the queries of ``page_queries``: what the pages were built from, or regular expressions
over their markup."""

from __future__ import annotations

from hirelens import rules
from hirelens.plans.inputs import CRITERIA_LABELS, SELECTED, selected_element
from hirelens.plans.oracle_base import strip, with_postings

_TEXT = "replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


def _plain(markup: str) -> str:
    """Text of simple markup."""
    return _TEXT.format(strip(markup))


_MISSING = "doc_id % 13 = 12"
_ESCAPED = "replace(replace(replace(description, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_BODY = f"'<p>' || replace({_ESCAPED}, chr(10), '<br/>') || '</p>'"
_NO_SPACE = "regexp_replace({}, '\\s+', '', 'g')"
# the description the page gives: marked, or the longest block when it is long enough
_PIECES = (
    f"list_filter(list_transform(string_split(description, chr(10)), lambda x: {strip('x')}),"
    " lambda x: x <> '')"
)
_JOINED = f"array_to_string({_PIECES}, chr(10))"
_METHOD = (
    f"CASE WHEN {_MISSING} THEN NULL WHEN doc_id % 11 <> 10 AND length({_JOINED}) > 50 THEN 0"
    f" WHEN length({_JOINED}) > 200 THEN -1 END"
)
_FOUND = f"found AS (SELECT *, {_METHOD} AS method FROM postings)"
_ERROR = (
    f"CASE WHEN {_MISSING} THEN '{rules.FETCH_FAILED}' WHEN method IS NULL"
    f" THEN '{rules.DESCRIPTION_FAILED}' END"
)
_SALARY = f"CASE WHEN NOT {_MISSING} THEN salary_raw END"
_APPLICANTS = f"CASE WHEN NOT {_MISSING} THEN applicant_count_raw END"
_EMPLOYMENT = f"CASE WHEN NOT {_MISSING} THEN employment_type_raw END"
_TITLE = "coalesce(raw_title, '')"
_URL = "split_part(job_url, '?', 1)"
_COMPANY_URL = "split_part(company_url, '?', 1)"
_ABOUT = "'About ' || s_name || chr(10) || 'We hire.'"
_FACTS = {
    "industry": "CASE WHEN s_suppkey % 3 <> 0 THEN 'Industry ' || s_nationkey ELSE 'Fallback' END",
    "size": "s_suppkey || ' employees'",
    "headquarters": "n_name",
    "type": "'Private'",
    "specialties": "CAST(NULL AS VARCHAR)",
    "founded": "CAST(NULL AS VARCHAR)",
    "website": "'http://s' || s_suppkey || '.example'",
}
_SUPPLIERS = "supplier JOIN nation ON s_nationkey = n_nationkey"
_QUALITY = (
    "CASE CAST({} IS NOT NULL AS INTEGER) + CAST({} IS NOT NULL AS INTEGER)"
    " + CAST({} IS NOT NULL AS INTEGER) WHEN 3 THEN 'high' WHEN 0 THEN 'low' ELSE 'medium' END"
)
_INSIGHT = (
    "array_to_string(list_filter([coalesce(raw_title, ''), " + strip("raw_location")
    + ", salary_raw, applicant_count_raw], lambda x: x <> ''), chr(10))"
)
_INSIGHT_HTML = (
    "length('<section class=\"top-card-layout\"><h1>' || coalesce(raw_title, '') || '</h1>"
    "<span class=\"topcard__flavor--bullet\">' || raw_location || '</span>'"
    " || CASE WHEN salary_raw IS NULL THEN '' ELSE '<span class=\"top-card-layout__salary-info\"> '"
    " || salary_raw || '</span>' END"
    " || CASE WHEN applicant_count_raw IS NULL THEN '' ELSE"
    " '<figcaption class=\"num-applicants__caption\">' || chr(10) || applicant_count_raw"
    " || '</figcaption>' END || '</section>')"
)


_HITS = (
    "CAST(CASE WHEN method IS NULL THEN 0 ELSE 3 + CAST(salary_raw IS NOT NULL AS INTEGER)"
    " + CAST(applicant_count_raw IS NOT NULL AS INTEGER) + 2 * CAST(employment_type_raw IS NOT NULL AS"
    " INTEGER) + CASE WHEN doc_id % 5 <> 4 THEN 2 ELSE 0 END END AS INTEGER)"
)


def _company_columns() -> str:
    return ", ".join(f"{sql} AS company_{name}_raw" for name, sql in _FACTS.items())


def _every_selector() -> str:
    def text(name: str) -> str:
        return f"'{SELECTED[name][1]} ' || doc_id"

    def method(name: str) -> str:
        return f"CAST(doc_id % {len(SELECTED[name][0])} AS INTEGER)"

    columns = [
        "doc_id",
        f"{text('description')} AS description",
        f"{method('description')} AS description_extract_method",
        f"md5({selected_element('description')}) AS description_html_hash",
        f"{text('location')} AS location_from_panel_raw",
        f"{text('insight')} AS job_insight_section_raw_text",
        f"md5({selected_element('insight')}) AS insight_html_hash",
    ]
    for name in ("salary", "applicant_count", "easy_apply_flag", "remote_label", "posted_by"):
        columns += [
            f"{text(name)} AS {name}_raw", f"'success' AS {name}_status", f"{method(name)} AS {name}_method"
        ]
    for label, (name, _) in zip(CRITERIA_LABELS, rules.CRITERIA_COLUMNS):
        columns.append(f"'{label.strip()} ' || doc_id AS {name}")
    return f"SELECT {', '.join(columns)}, 7 AS selector_hits FROM documents"


def _every_fact() -> str:
    facts = ", ".join(f"'{name} ' || s_suppkey AS company_{name}_raw" for _, name in rules.COMPANY_FACTS)
    return (
        "SELECT s_suppkey, 'About supplier ' || s_suppkey AS company_about_raw_text, CAST(s_suppkey %"
        f" {len(rules.ABOUT_SELECTORS)} AS INTEGER) AS company_about_method, {facts} FROM supplier"
    )


ORACLES = {
    "every_selector": _every_selector(),
    "every_fact": _every_fact(),
    "collect_jobs": with_postings(
        f"SELECT sha256({_URL}) AS job_id_raw, {_URL} AS job_url, {_TITLE} AS title_raw,"
        f" applicant_count_raw, {_QUALITY.format('description', 'salary_raw', 'applicant_count_raw')}"
        f" AS extraction_quality, {_HITS} AS selector_hits, '2026-02-21T00:00:00' AS scrape_timestamp"
        " FROM found WHERE method IS NOT NULL AND doc_id % 10 < 8 AND NOT EXISTS (SELECT 1 FROM postings"
        f" o WHERE o.scrape_timestamp < '2026-02-17' AND {_URL.replace('job_url', 'o.job_url')} ="
        f" {_URL.replace('job_url', 'found.job_url')})",
        _FOUND,
    ),
    "collect_companies": with_postings(
        f"SELECT sha256({_COMPANY_URL}) AS company_id_hash, min(company) AS company_name_raw,"
        f" {_COMPANY_URL} AS company_url, any_value(s_suppkey || ' employees') AS company_size_raw,"
        f" '2026-02-21T00:00:00' AS first_seen FROM postings JOIN (SELECT * FROM {_SUPPLIERS})"
        f" ON {_COMPANY_URL} = 'https://co.example/c/' || s_suppkey GROUP BY 1, 3"
    ),
    "scan_pages": "SELECT page_id, url, CAST(length(html) AS INTEGER) AS chars FROM pages",
    "html_elements": "SELECT page_id, len(regexp_extract_all(html, '<p>')) AS paragraphs,"
    " len(regexp_extract_all(html, '<a ')) AS links,"
    " len(regexp_extract_all(html, '<script')) AS scripts,"
    f" {_plain('regexp_extract(html, $$<title>([^<]*)</title>$$, 1)')} AS title,"
    f" nullif({_plain('regexp_extract(html, $$<div class=.ad.>([^<]*)</div>$$, 1)')}, '') AS ad"
    " FROM pages",
    "selector_cascade": "SELECT page_id, nullif(t, '') AS ad_raw, CASE WHEN t <> '' THEN 'success'"
    " ELSE 'not_found' END AS ad_status, CASE WHEN t <> '' THEN 1 END AS ad_method FROM (SELECT"
    f" page_id, {_plain('regexp_extract(html, $$<div class=.ad.>([^<]*)</div>$$, 1)')} AS t FROM pages)",
    "longest_text": "SELECT p.page_id, longest FROM pages p LEFT JOIN (SELECT page_id, arg_max(t,"
    " length(t) * 1000000 - pos) AS longest FROM (SELECT page_id, generate_subscripts(ls, 1) AS pos,"
    f" {_plain('regexp_replace(unnest(ls), $$<[^>]*>$$, $$$$, $$g$$)')} AS t FROM (SELECT page_id,"
    " regexp_extract_all(html, '<li>(.*?)</li>', 1) AS ls FROM pages)) WHERE t <> '' GROUP BY page_id) l"
    " ON p.page_id = l.page_id",
    "extract_description": with_postings(
        f"SELECT doc_id, CASE WHEN method IS NOT NULL THEN md5({_NO_SPACE.format('description')}) END"
        " AS text_hash, method FROM found",
        _FOUND,
    ),
    "extract_description_html": with_postings(
        f"SELECT doc_id, CASE WHEN NOT {_MISSING} AND doc_id % 11 <> 10 THEN"
        f" md5('<div class=\"show-more-less-html__markup clamp\">' || {_BODY} || '</div>') END"
        " AS html_hash FROM postings"
    ),
    "extract_location_panel": with_postings(
        f"SELECT doc_id, CASE WHEN NOT {_MISSING} THEN {strip('raw_location')} END AS location"
        " FROM postings"
    ),
    "extract_insight": with_postings(
        f"SELECT doc_id, CASE WHEN NOT {_MISSING} THEN {_INSIGHT} END AS text,"
        f" CAST(CASE WHEN NOT {_MISSING} THEN {_INSIGHT_HTML} END AS INTEGER) AS html_chars FROM postings"
    ),
    "extract_status_fields": with_postings(
        f"SELECT doc_id, {_SALARY} AS salary_raw, CASE WHEN {_SALARY} IS NULL THEN 'not_found' ELSE"
        f" 'success' END AS salary_status, CASE WHEN {_SALARY} IS NOT NULL THEN 1 END AS salary_method,"
        f" {_APPLICANTS} AS applicant_count_raw, CASE WHEN {_APPLICANTS} IS NULL THEN 'not_found' ELSE"
        " 'success' END AS applicant_count_status,"
        f" CASE WHEN {_APPLICANTS} IS NOT NULL THEN 2 END AS applicant_count_method,"
        " 'not_found' AS easy_apply_flag_status, 'not_found' AS remote_label_status,"
        " 'not_found' AS posted_by_status FROM postings"
    ),
    "extract_criteria_map": with_postings(
        f"SELECT doc_id, CASE WHEN {_MISSING} THEN NULL WHEN employment_type_raw IS NULL THEN '' ELSE"
        " 'employment_type=' || employment_type_raw || ';industries=Software & Data' END AS criteria"
        " FROM postings"
    ),
    "extract_criteria_cols": with_postings(
        f"SELECT doc_id, {_EMPLOYMENT} AS employment_type_raw, CAST(NULL AS VARCHAR) AS seniority_raw,"
        f" CASE WHEN {_EMPLOYMENT} IS NOT NULL THEN 'Software & Data' END AS industry_raw,"
        " CAST(NULL AS VARCHAR) AS job_function_raw FROM postings"
    ),
    "extract_json_ld": with_postings(
        f"SELECT doc_id, CASE WHEN NOT {_MISSING} AND doc_id % 5 <> 4 THEN '{{\"n\":' || doc_id || '}}'"
        " END AS json_ld FROM postings"
    ),
    "extract_job_json": with_postings(
        f"SELECT doc_id, CASE WHEN NOT {_MISSING} AND doc_id % 5 <> 4 THEN '{{\"jobPosting\":[' || doc_id"
        " || ',{\"a\":1}]}' END AS job_json FROM postings"
    ),
    "selector_hits": with_postings(
        f"SELECT doc_id, {_HITS} AS selector_hits, method IS NOT NULL AS success, {_ERROR} AS error FROM found",
        _FOUND,
    ),
    "extract_company_about": f"SELECT s_suppkey, {_ABOUT} AS company_about_raw_text,"
    " '<section data-test-id=\"about-us\"><p>About ' || s_name || '</p><p>We hire.</p></section>'"
    f" AS company_about_raw_html, 4 AS company_about_method FROM {_SUPPLIERS}",
    "extract_company_facts": f"SELECT s_suppkey, {_company_columns()} FROM {_SUPPLIERS}",
    "cards_from_pages": with_postings(
        "SELECT doc_id // 25 AS page_id, CAST(row_number() OVER (PARTITION BY doc_id // 25 ORDER BY"
        f" doc_id) - 1 AS INTEGER) AS card, {_TITLE} AS raw_title, company, {strip('raw_location')}"
        " AS raw_location, date_posted_raw, '2026-01-01' AS date_posted_attr,"
        f" {_URL} AS job_url, {_COMPANY_URL} AS company_url FROM postings"
    ),
    "hash_company_about": f"SELECT s_suppkey, sha256({_ABOUT}) AS hash FROM {_SUPPLIERS}",
    "gate_success": with_postings(
        "SELECT doc_id, job_url FROM found WHERE method IS NOT NULL", _FOUND
    ),
    "failed_pages": with_postings(
        f"SELECT job_url, raw_title, company, {_ERROR} AS reason, scrape_timestamp AS timestamp"
        " FROM found WHERE method IS NULL",
        _FOUND,
    ),
    "build_raw_job": with_postings(
        f"SELECT '{rules.SCRAPER_VERSION}' AS scraper_version, '{rules.RAW_VERSION}'"
        " AS raw_schema_version, 'Data Scientist' AS search_keyword, scrape_timestamp,"
        " sha256(job_url) AS job_id_raw, job_url, raw_title AS title_raw, salary_raw AS"
        " salary_raw_text, CASE WHEN salary_raw IS NULL THEN 'not_found' ELSE 'success' END AS"
        " salary_status, employment_type_raw, sha256(company_url) AS company_id_hash,"
        f" {_QUALITY.format('description', 'salary_raw', 'applicant_count_raw')}"
        " AS extraction_quality, 0 AS retry_count, 0 AS status_codes, true AS same_id,"
        " true AS has_hash FROM found WHERE method IS NOT NULL",
        _FOUND,
    ),
    "build_raw_company": "SELECT sha256('https://co.example/c/' || s_suppkey) AS company_id_hash,"
    " s_name AS company_name_raw, 'https://co.example/c/' || s_suppkey AS company_url,"
    f" {_FACTS['industry']} AS company_industry_raw, {_FACTS['size']} AS company_size_raw,"
    f" {_FACTS['website']} AS company_website_raw, sha256({_ABOUT}) AS about_hash,"
    " '2026-02-' || day || 'T20:31:07' AS first_seen, 7 AS selector_hits"
    f" FROM {_SUPPLIERS} CROSS JOIN (VALUES (16), (18), (20)) d(day)",
    "raw_to_columns": with_postings(
        f"SELECT raw_title, company, raw_location, date_posted_raw, {_URL} AS job_url,"
        " md5(description) AS description, employment_type_raw, scrape_timestamp,"
        f" {_QUALITY.format('description', 'salary_raw', 'applicant_count_raw')}"
        " AS extraction_quality FROM postings"
    ),
    "quality_level": with_postings(
        "SELECT doc_id, "
        + _QUALITY.format(
            "(CASE WHEN doc_id % 29 <> 0 THEN description END)", "salary_raw", "applicant_count_raw"
        )
        + " AS level FROM postings"
    ),
    "job_company": with_postings(
        f"SELECT {_URL} AS job_url, scrape_timestamp, s_name AS company_name,"
        f" CASE WHEN s_suppkey IS NOT NULL THEN {_FACTS['industry']} END AS company_industry,"
        f" {_FACTS['size']} AS company_size FROM postings LEFT JOIN (SELECT * FROM {_SUPPLIERS})"
        f" ON {_COMPANY_URL} = 'https://co.example/c/' || s_suppkey"
    ),
}
