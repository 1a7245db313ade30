"""Declared schemas. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, INTEGER, DATE = T.StringType(), T.IntegerType(), T.DateType()
STRINGS, INTEGERS = T.ArrayType(STRING), T.ArrayType(INTEGER)

# FIXED VALUES: names, order and types of the fields of every kind of record
CARD = T.StructType(
    [
        T.StructField("raw_title", STRING),
        T.StructField("company", STRING),
        T.StructField("raw_location", STRING),
        T.StructField("date_posted_raw", STRING),
        T.StructField("date_posted_attr", STRING),
        T.StructField("job_url", STRING),
        T.StructField("company_url", STRING),
    ]
)
RAW_JOB = T.StructType(
    [
        T.StructField("scraper_version", STRING),
        T.StructField("raw_schema_version", STRING),
        T.StructField(
            "scrape_metadata",
            T.StructType(
                [
                    T.StructField("search_keyword", STRING),
                    T.StructField("search_location", STRING),
                    T.StructField("scrape_timestamp", STRING),
                    T.StructField("user_agent_used", STRING),
                ]
            ),
        ),
        T.StructField(
            "job_identity",
            T.StructType(
                [
                    T.StructField("job_id_raw", STRING),
                    T.StructField("job_url", STRING),
                ]
            ),
        ),
        T.StructField(
            "job_card_raw",
            T.StructType(
                [
                    T.StructField("title_raw", STRING),
                    T.StructField("company_raw", STRING),
                    T.StructField("location_raw", STRING),
                    T.StructField("date_posted_raw", STRING),
                    T.StructField("date_posted_attr", STRING),
                ]
            ),
        ),
        T.StructField(
            "job_page_raw",
            T.StructType(
                [
                    T.StructField("job_description_raw_text", STRING),
                    T.StructField("job_description_raw_html", STRING),
                    T.StructField("description_extract_method", INTEGER),
                    T.StructField("job_insight_section_raw_text", STRING),
                    T.StructField("job_insight_section_raw_html", STRING),
                    T.StructField("salary_raw_text", STRING),
                    T.StructField("salary_status", STRING),
                    T.StructField("applicant_count_raw", STRING),
                    T.StructField("applicant_count_status", STRING),
                    T.StructField("easy_apply_flag_raw", STRING),
                    T.StructField("easy_apply_flag_status", STRING),
                    T.StructField("remote_label_raw", STRING),
                    T.StructField("remote_label_status", STRING),
                    T.StructField("posted_by_raw", STRING),
                    T.StructField("posted_by_status", STRING),
                    T.StructField("location_from_panel_raw", STRING),
                    T.StructField("employment_type_raw", STRING),
                    T.StructField("seniority_raw", STRING),
                    T.StructField("industry_raw", STRING),
                    T.StructField("job_function_raw", STRING),
                    T.StructField("embedded_json_ld", STRING),
                    T.StructField("embedded_job_json", STRING),
                ]
            ),
        ),
        T.StructField(
            "company_info",
            T.StructType(
                [
                    T.StructField("company_url", STRING),
                    T.StructField("company_id_hash", STRING),
                ]
            ),
        ),
        T.StructField(
            "quality_tracking",
            T.StructType(
                [
                    T.StructField("extraction_quality", STRING),
                    T.StructField("selector_hits", INTEGER),
                    T.StructField("status_code_history", INTEGERS),
                    T.StructField("retry_count", INTEGER),
                ]
            ),
        ),
        T.StructField(
            "hashing",
            T.StructType(
                [
                    T.StructField("job_description_content_hash", STRING),
                    T.StructField("job_post_id_hash", STRING),
                ]
            ),
        ),
    ]
)
RAW_COMPANY = T.StructType(
    [
        T.StructField("scraper_version", STRING),
        T.StructField("raw_schema_version", STRING),
        T.StructField(
            "company_identity",
            T.StructType(
                [
                    T.StructField("company_id_hash", STRING),
                    T.StructField("company_name_raw", STRING),
                    T.StructField("company_url", STRING),
                ]
            ),
        ),
        T.StructField(
            "company_page_raw",
            T.StructType(
                [
                    T.StructField("company_about_raw_text", STRING),
                    T.StructField("company_about_raw_html", STRING),
                    T.StructField("company_industry_raw", STRING),
                    T.StructField("company_size_raw", STRING),
                    T.StructField("company_headquarters_raw", STRING),
                    T.StructField("company_type_raw", STRING),
                    T.StructField("company_specialties_raw", STRING),
                    T.StructField("company_founded_year", STRING),
                    T.StructField("company_website_raw", STRING),
                    T.StructField("company_employees_count_raw", STRING),
                ]
            ),
        ),
        T.StructField(
            "hashing",
            T.StructType(
                [
                    T.StructField("company_content_hash", STRING),
                    T.StructField("company_about_content_hash", STRING),
                    T.StructField("company_id_hash", STRING),
                ]
            ),
        ),
        T.StructField(
            "timestamps",
            T.StructType(
                [
                    T.StructField("first_seen", STRING),
                    T.StructField("last_seen", STRING),
                ]
            ),
        ),
        T.StructField(
            "quality_tracking",
            T.StructType(
                [
                    T.StructField("extraction_quality", STRING),
                    T.StructField("retry_count", INTEGER),
                    T.StructField("selector_hits", INTEGER),
                ]
            ),
        ),
    ]
)
PARSED_JOB = T.StructType(
    [
        T.StructField("job_id", STRING),
        T.StructField("company", STRING),
        T.StructField("raw_title", STRING),
        T.StructField("normalized_title", STRING),
        T.StructField("title_keywords", STRINGS),
        T.StructField("role_type", STRING),
        T.StructField("seniority_level", STRING),
        T.StructField("skills_required", STRINGS),
        T.StructField("skills_optional", STRINGS),
        T.StructField("tools_frameworks", STRINGS),
        T.StructField("min_years_experience", INTEGER),
        T.StructField("experience_text", STRING),
        T.StructField("employment_type", STRING),
        T.StructField("work_mode", STRING),
        T.StructField("city", STRING),
        T.StructField("region", STRING),
        T.StructField("country", STRING),
        T.StructField("date_posted_raw", STRING),
        T.StructField("date_posted_normalized", DATE),
        T.StructField("job_description_raw", STRING),
        T.StructField("source", STRING),
        T.StructField("job_url", STRING),
        T.StructField("scrape_timestamp", STRING),
        T.StructField("schema_version", STRING),
        T.StructField("dataset_version", STRING),
    ]
)
REJECT = T.StructType(
    [
        T.StructField("job_url", STRING),
        T.StructField("raw_title", STRING),
        T.StructField("company", STRING),
        T.StructField("reason", STRING),
        T.StructField("timestamp", STRING),
    ]
)
PROFILE = T.StructType(
    [
        T.StructField("profile_id", STRING),
        T.StructField("standardized_role", STRING),
        T.StructField("candidate_skills", STRINGS),
        T.StructField("experience_years", INTEGER),
        T.StructField("education_level", STRING),
        T.StructField("certifications", STRINGS),
        T.StructField("seniority_level", STRING),
        T.StructField("language", STRING),
        T.StructField("derived_from", STRING),
    ]
)


def leaf_paths(struct: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all fields that are not structs, in order."""
    paths: list[str] = []
    for f in struct.fields:
        path = prefix + f.name
        if isinstance(f.dataType, T.StructType):
            paths += leaf_paths(f.dataType, path + ".")
        else:
            paths.append(path)
    return paths


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order, missing ones as null, each cast to its declared type."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
