"""Raw columns to parsed postings: one narrow projection between two filters, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import rules, schemas
from hirelens.functions.dates import normalize_date
from hirelens.functions.location import parse_location
from hirelens.functions.roles import (
    employment_type,
    experience,
    role_type,
    seniority,
    work_mode,
)
from hirelens.functions.skills import extract_skills
from hirelens.functions.text import job_id16, na_to_null, strip
from hirelens.functions.title import normalize_title, title_keywords
from hirelens.operators.staging import with_once

MIN_DESCRIPTION = 50  # FIXED VALUE: characters of a description worth parsing


def long_enough(description: Column, at_least: int = MIN_DESCRIPTION) -> Column:
    return F.coalesce(F.length(strip(description)) >= at_least, F.lit(False))


def gate_description(df: DataFrame, description: str = "description") -> DataFrame:
    """Drop rows without a description or with a thin one."""
    return df.filter(long_enough(F.col(description)))


def gate_skills(df: DataFrame) -> DataFrame:
    """Drop rows without any skill. If only optional ones are found they have become required."""
    return df.filter(F.size("skills_required") + F.size("skills_optional") > 0)


def with_skills(df: DataFrame, description: str = "description", **tables) -> DataFrame:
    names = ["skills_required", "skills_optional", "tools_frameworks"]
    found = with_once(df, {"_skills": extract_skills(F.col(description), **tables)})
    return found.select(*df.columns, *[F.col(f"_skills.{n}").alias(n) for n in names])


def parse_postings(df: DataFrame, source: str = rules.DEFAULT_SOURCE) -> DataFrame:
    """Parsed rows of all postings with a description and at least one skill.

    Input columns: ``raw_title, company, raw_location, date_posted_raw, job_url, description,
    scrape_timestamp`` and, where known, ``employment_type_raw``. Relative dates count from the
    collection time, never from the clock. Other columns pass through behind the parsed ones.
    """
    body, title = F.col("description"), F.col("raw_title")
    page_type = (
        F.col("employment_type_raw") if "employment_type_raw" in df.columns else F.lit(None)
    )
    kept = df.transform(gate_description).transform(with_skills).transform(gate_skills)
    staged = kept.withColumns(
        {"_experience": experience(body), "_place": parse_location(F.col("raw_location"))}
    )
    years = F.col("_experience.min_years_experience")
    parsed = staged.withColumns(
        {
            "job_id": job_id16(F.col("job_url")),
            "company": na_to_null(F.col("company")),
            "normalized_title": normalize_title(title),
            "title_keywords": title_keywords(title),
            "role_type": role_type(title, body, F.col("tools_frameworks")),
            "seniority_level": seniority(title, body, years),
            "min_years_experience": years,
            "experience_text": F.col("_experience.experience_text"),
            "employment_type": employment_type(body, page_type.cast("string")),
            "work_mode": work_mode(body, F.col("raw_location")),
            "city": F.col("_place.city"),
            "region": F.col("_place.region"),
            "country": F.col("_place.country"),
            "date_posted_normalized": normalize_date(
                F.col("date_posted_raw"), F.col("scrape_timestamp")
            ),
            "date_posted_raw": na_to_null(F.col("date_posted_raw")),
            "job_description_raw": body,
            "source": F.lit(source),
            "schema_version": F.lit(rules.PARSED_SCHEMA_VERSION),
            "dataset_version": F.lit(rules.DATASET_VERSION),
        }
    )
    names = schemas.PARSED_JOB.names
    used = {"raw_location", "description", "employment_type_raw"}
    passed = [c for c in df.columns if c not in names and c not in used]
    return parsed.select(*names, *passed)


def parse_rejects(df: DataFrame) -> DataFrame:
    """What ``parse_postings`` drops, with the reason."""
    thin = ~long_enough(F.col("description"))
    no_skills = F.size(extract_skills(F.col("description"))["skills_required"]) == 0
    reason = F.when(thin, "no description").when(no_skills, "no skills found")
    lost = with_once(df, {"reason": reason}).filter(F.col("reason").isNotNull())
    return schemas.conform(lost.withColumn("timestamp", F.col("scrape_timestamp")), schemas.REJECT)
