"""SQL for the queries of ``parse_queries``."""

from __future__ import annotations

from hirelens import rules
from hirelens.plans.oracle_base import (
    COUNTRIES,
    EMPLOYMENT,
    HIT,
    KEYWORDS,
    NORMALIZED_TITLE,
    PLACE,
    POSTED_DAY,
    ROLE,
    SENIORITY,
    SENTENCE,
    VOCABULARY,
    WORK_MODE,
    YEARS,
    first_hit,
    joined,
    level_of_rank,
    over_parsed,
    over_postings,
    paragraphs,
    quote,
    rank_of,
    scores,
    skills,
    state,
    strip,
    with_postings,
    years_rank,
)

_THIN = f"(description IS NULL OR length({strip('description')}) < 50)"
_BARE = (
    "bare AS (SELECT * REPLACE (CASE WHEN doc_id % 2 = 0 THEN description ELSE text END"
    " AS description) FROM postings)"
)


def _skills_of(text: str, source: str, key: str = "doc_id") -> str:
    """CTE ``hits(doc_id, skills)`` of a plain vocabulary search."""
    return (
        f"{VOCABULARY}, p AS (SELECT {key}, lower({text}) AS low FROM {source}),"
        f" hits AS (SELECT {key}, list(DISTINCT skill ORDER BY skill) AS skills FROM p"
        f" JOIN vocabulary v ON {HIT} GROUP BY {key})"
    )


_VERBS = [w for w, _ in rules.SENIORITY_VERBS] + ["rag", "ores", "the", "hand"]
_WORDS = ", ".join(f"CASE WHEN contains(lower(text), {quote(w)}) THEN {quote(w)} END" for w in _VERBS)
_SECTION_CHARS = "coalesce(sum(length(regexp_replace(p, '\\s', '', 'g'))) FILTER (state = '{}'), 0)"

_LAST_PART = "string_split(raw_location, ', ')[-1]"

ORACLES = {
    "parsed_jobs": with_postings(
        f"SELECT {NORMALIZED_TITLE} AS normalized_title, country, {WORK_MODE} AS work_mode, count(*)"
        " AS n FROM postings p JOIN place l ON p.doc_id = l.doc_id"
        f" WHERE length({strip('description')}) >= 50 GROUP BY ALL",
        PLACE,
    ),
    "parse_job": over_parsed(
        f"SELECT doc_id, job_id, company, raw_title, normalized_title, title_keywords, role_type,"
        f" seniority_level, {joined('req')} AS skills_required, {joined('opt')} AS skills_optional,"
        f" {joined('tools')} AS tools_frameworks, min_years_experience, experience_text,"
        " employment_type, work_mode, city, region, country, date_posted_raw,"
        " date_posted_normalized, md5(description) AS job_description_raw,"
        f" '{rules.DEFAULT_SOURCE}' AS source, job_url, scrape_timestamp,"
        f" '{rules.PARSED_SCHEMA_VERSION}' AS schema_version, '{rules.DATASET_VERSION}'"
        " AS dataset_version FROM parsed"
    ),
    "strip_query": over_postings("split_part(job_url, '?', 1) AS url"),
    "company_about_url": over_postings(
        "regexp_replace(split_part(company_url, '?', 1), '/+$', '') || '/about/' AS url"
    ),
    "keyword_slug": over_postings(
        "replace(replace(lower(raw_title), ' ', '_'), '/', '_') AS slug"
    ),
    "na_to_null": over_postings(
        "CASE WHEN company <> 'N/A' THEN company END AS company,"
        " CASE WHEN date_posted_raw <> 'N/A' THEN date_posted_raw END AS date_posted_raw"
    ),
    "filter_has_url": with_postings("SELECT doc_id, job_url FROM postings WHERE doc_id % 4 = 1"),
    "gate_description": with_postings(f"SELECT doc_id FROM postings WHERE NOT {_THIN}"),
    "gate_skills": f"WITH {skills('documents', 'text')} SELECT doc_id, {joined('req')} AS skills"
    " FROM skills WHERE len(req) + len(opt) > 0",
    "reject_rows": with_postings(
        f"SELECT job_url, raw_title, company, CASE WHEN {_THIN} THEN 'no description'"
        " ELSE 'no skills found' END AS reason, scrape_timestamp AS timestamp FROM bare b JOIN skills s"
        f" ON b.doc_id = s.doc_id WHERE {_THIN} OR len(req) + len(opt) = 0",
        _BARE,
        skills("bare"),
    ),
    "hash_content": f"SELECT doc_id, sha256(nullif({strip('text')}, '')) AS sha,"
    f" md5(nullif({strip('text')}, '')) AS md5 FROM documents",
    "hash_description": over_postings(f"sha256(nullif({strip('description')}, '')) AS hash"),
    "hash_job_url": over_postings("sha256(split_part(job_url, '?', 1)) AS hash"),
    "hash_company_url": over_postings("sha256(split_part(company_url, '?', 1)) AS hash"),
    "job_id16": over_postings("left(sha256(lower(job_url)), 16) AS job_id"),
    "normalize_title": over_postings(f"{NORMALIZED_TITLE} AS normalized_title"),
    "title_keywords": over_postings(f"{joined(KEYWORDS)} AS keywords"),
    "keep_order_distinct": over_postings(f"{joined(KEYWORDS)} AS keywords"),
    "find_skills": f"WITH {_skills_of('text', 'documents')} SELECT d.doc_id, {joined('skills')}"
    " AS skills FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id",
    "sort_skills": with_postings(
        "SELECT q.doc_id, array_to_string(list_sort(coalesce(skills, []) || ['Zeta', 'alpha']), '|')"
        " AS skills FROM postings q LEFT JOIN hits h ON q.doc_id = h.doc_id",
        _skills_of("raw_title", "postings"),
    ),
    "skill_union": with_postings(
        f"SELECT q.doc_id, {joined('skills')} AS skills FROM postings q LEFT JOIN hits h"
        " ON q.doc_id = h.doc_id",
        _skills_of("concat_ws(' | ', raw_title, description)", "postings"),
    ),
    "split_paragraphs": with_postings(
        "SELECT doc_id, CAST(pos AS INTEGER) AS pos, md5(p) AS paragraph, CAST(length(p) AS INTEGER)"
        " AS chars FROM paragraphs",
        paragraphs(),
    ),
    "section_label": with_postings(
        "SELECT doc_id, CAST(pos AS INTEGER) AS pos, label FROM paragraphs", paragraphs()
    ),
    "section_state": with_postings(
        f"SELECT doc_id, CAST({_SECTION_CHARS.format('required')} AS INTEGER) AS required_chars,"
        f" CAST({_SECTION_CHARS.format('optional')} AS INTEGER) AS optional_chars"
        " FROM paragraphs GROUP BY doc_id",
        paragraphs(),
    ),
    "extract_skills": with_postings(
        f"SELECT doc_id, {joined('req')} AS skills_required, {joined('opt')} AS skills_optional,"
        f" {joined('tools')} AS tools_frameworks FROM skills",
        skills(),
    ),
    "skill_sets": with_postings(
        "SELECT q.doc_id, coalesce(string_agg(skill, '|' ORDER BY skill), '') AS either,"
        " coalesce(string_agg(skill, '|' ORDER BY skill) FILTER (o AND NOT r), '') AS only_optional,"
        " coalesce(string_agg(skill, '|' ORDER BY skill) FILTER (o AND r), '') AS both"
        " FROM postings q LEFT JOIN (SELECT doc_id, skill, bool_or(state = 'required') AS r,"
        " bool_or(state = 'optional') AS o FROM found GROUP BY ALL) f ON q.doc_id = f.doc_id"
        " GROUP BY q.doc_id",
        skills(),
    ),
    "vocab_match": f"SELECT doc_id, {joined(f'list_filter([{_WORDS}], lambda w: w IS NOT NULL)')}"
    " AS words FROM documents",
    "first_match": over_postings(
        first_hit("lower(raw_title)", rules.TITLE_RULES, "'none'") + " AS family"
    ),
    "role_score": with_postings(
        "SELECT doc_id, role, score FROM scores",
        scores("SELECT doc_id, ['Docker', 'LangChain'] AS tools FROM postings"),
    ),
    "role_type": with_postings(
        "SELECT doc_id, role_type FROM roles",
        skills(),
        scores("SELECT doc_id, tools FROM skills"),
        ROLE,
    ),
    "seniority": over_postings(f"{SENIORITY} AS seniority_level"),
    "max_rank": over_postings(
        f"CAST({rank_of('lower(raw_title)', rules.SENIORITY_TITLE)} AS INTEGER) AS rank"
    ),
    "years_bucket": over_postings(
        f"nullif({level_of_rank(years_rank('doc_id % 103'))}, 'Unknown') AS level,"
        f" CAST({years_rank('doc_id % 103')} AS INTEGER) AS rank"
    ),
    "experience": over_postings(
        f"{YEARS} AS min_years_experience, {SENTENCE} AS experience_text"
    ),
    "employment_type": over_postings(f"{EMPLOYMENT} AS employment_type"),
    "work_mode": over_postings(f"{WORK_MODE} AS work_mode"),
    "normalize_date": over_postings(f"date_posted_raw, {POSTED_DAY} AS day"),
    "parse_location": with_postings("SELECT doc_id, city, region, country FROM place", PLACE),
    "state_lookup": over_postings(f"{state(_LAST_PART)} AS state"),
    "country_member": over_postings(f"lower({_LAST_PART}) IN {COUNTRIES} AS known"),
    "json_valid": "SELECT event_id, json_valid(CASE WHEN event_id % 3 = 0 THEN substring(props, 1, 4)"
    " ELSE props END) AS valid FROM events",
    "json_first_block": "SELECT event_id, regexp_extract(props, '\\{[^}]*\\}') AS block FROM events",
}
