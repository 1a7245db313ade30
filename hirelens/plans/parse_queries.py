"""Queries of the per-row functions, the gates and the parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions import dates, embedded_json, location, matching, roles, skills, text, title
from hirelens.operators import postings as post
from hirelens.operators.market import seniority_rank
from hirelens.operators.records import filter_has_url
from hirelens.operators.staging import with_once
from hirelens.plans import inputs

c = F.col


def joined(values: Column) -> Column:
    """A list as one text, so that both engines compare the same thing."""
    return F.array_join(values, "|")


def over_postings(spark: SparkSession, sf_dir: str, *keep: str, **columns: Column) -> DataFrame:
    """The posting's id, some of its columns and new ones."""
    new = [value.alias(name) for name, value in columns.items()]
    return inputs.postings(spark, sf_dir).select("doc_id", *keep, *new)


def minimal_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings by canonical title, country and work mode."""
    kept = inputs.postings(spark, sf_dir).transform(post.gate_description)
    return (
        kept.select(
            title.normalize_title(c("raw_title")).alias("normalized_title"),
            location.parse_location(c("raw_location"))["country"].alias("country"),
            roles.work_mode(c("description"), c("raw_location")).alias("work_mode"),
        )
        .groupBy("normalized_title", "country", "work_mode")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def parse_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ["title_keywords", "skills_required", "skills_optional", "tools_frameworks"]
    df = inputs.parsed(spark, sf_dir)
    return df.withColumns(
        {
            **{name: joined(c(name)) for name in lists},
            "date_posted_normalized": c("date_posted_normalized").cast("string"),
            "job_description_raw": F.md5("job_description_raw"),
        }
    ).drop("company_url", "salary_raw", "applicant_count_raw", "text", "lang")


def gate_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.postings(spark, sf_dir).transform(post.gate_description).select("doc_id")


def gate_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the bare texts, of which many name no skill."""
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.transform(post.with_skills, "text").transform(post.gate_skills).select(
        "doc_id", joined(c("skills_required")).alias("skills")
    )


def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser drops of the bare texts and the postings."""
    p = inputs.postings(spark, sf_dir)
    bare = p.withColumn("description", F.when(c("doc_id") % 2 == 0, c("description")).otherwise(c("text")))
    return bare.transform(post.parse_rejects)


def find_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select("doc_id", joined(skills.find_skills(c("text"))).alias("skills"))


def split_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir).select(
        "doc_id", skills.split_paragraphs(c("description")).alias("ps")
    )
    exploded = p.select("doc_id", F.posexplode("ps").alias("pos", "p"))
    return exploded.select("doc_id", "pos", F.md5("p").alias("paragraph"), F.length("p").alias("chars"))


def section_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir).select(
        "doc_id", F.posexplode(skills.split_paragraphs(c("description"))).alias("pos", "p")
    )
    return p.select("doc_id", "pos", skills.section_label(c("p")).alias("label"))


def section_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many characters stand in required and in optional sections, white space left out."""
    p = inputs.postings(spark, sf_dir)
    parts = with_once(p.select("doc_id", "description"), {"s": skills.section_texts(c("description"))})
    return parts.select(
        "doc_id",
        F.length(F.regexp_replace("s.required", r"\s", "")).alias("required_chars"),
        F.length(F.regexp_replace("s.optional", r"\s", "")).alias("optional_chars"),
    )


def extract_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir).select("doc_id", "description").transform(post.with_skills)
    return p.select(
        "doc_id", *[joined(c(n)).alias(n) for n in p.columns if n not in ("doc_id", "description")]
    )


def skill_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union, difference and intersection of the skills of two sections."""
    p = inputs.postings(spark, sf_dir).select("doc_id", skills.section_texts(c("description")).alias("s"))
    found = p.select(
        "doc_id",
        skills.find_skills(c("s.required")).alias("r"),
        skills.find_skills(c("s.optional")).alias("o"),
    )
    return found.select(
        "doc_id",
        joined(skills.skill_union(c("r"), c("o"))).alias("either"),
        joined(F.array_except("o", "r")).alias("only_optional"),
        joined(F.array_sort(F.array_intersect("r", "o"))).alias("both"),
    )


def role_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = F.array(F.lit("Docker"), F.lit("LangChain"))
    p = inputs.postings(spark, sf_dir).select(
        "doc_id", roles.role_scores(c("raw_title"), c("description"), tools).alias("scores")
    )
    return p.select("doc_id", F.inline_outer("scores")).select("doc_id", "role", "score")


def role_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir).select("doc_id", "raw_title", "description").transform(post.with_skills)
    return p.select(
        "doc_id",
        roles.role_type(c("raw_title"), c("description"), c("tools_frameworks")).alias("role_type"),
    )


def seniority(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir).withColumn("e", roles.experience(c("description")))
    return p.select(
        "doc_id",
        roles.seniority(c("raw_title"), c("description"), c("e.min_years_experience")).alias(
            "seniority_level"
        ),
    )


def experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir).select("doc_id", roles.experience(c("description")).alias("e"))
    return p.select("doc_id", "e.*")


def parse_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir)
    return p.select("doc_id", location.parse_location(c("raw_location")).alias("l")).select(
        "doc_id", "l.*"
    )


def last_part() -> Column:
    return F.element_at(F.split("raw_location", ", "), -1)


def vocab_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seniority verbs and a few common syllables found in each text."""
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("low"))
    words = [w for w, _ in rules.SENIORITY_VERBS] + ["rag", "ores", "the", "hand"]
    return docs.select("doc_id", joined(matching.hits(c("low"), words)).alias("words"))


def keep_order_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of title and title again: each once, in vocabulary order."""
    p = inputs.postings(spark, sf_dir)
    twice = F.concat(title.title_keywords(c("raw_title")), title.title_keywords(c("raw_title")))
    return p.select("doc_id", joined(F.array_distinct(twice)).alias("keywords"))


def json_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On whole and on cut event properties."""
    e = inputs.table(spark, sf_dir, "events")
    cut = F.when(c("event_id") % 3 == 0, F.substring("props", 1, 4)).otherwise(c("props"))
    return e.select("event_id", embedded_json.json_valid(cut).alias("valid"))


def first_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First balanced block of a script built around event properties."""
    e = inputs.table(spark, sf_dir, "events")
    script = F.concat(F.lit("var a="), c("props"), F.lit(";f({x:[1]});"))
    return e.select("event_id", embedded_json.first_block(script).alias("block"))


QUERIES = {
    "parsed_jobs": minimal_slice,
    "parse_job": parse_job,
    "strip_query": lambda s, d: over_postings(s, d, url=text.strip_query(c("job_url"))),
    "company_about_url": lambda s, d: over_postings(s, d, url=text.company_about_url(c("company_url"))),
    "keyword_slug": lambda s, d: over_postings(s, d, slug=text.keyword_slug(c("raw_title"))),
    "na_to_null": lambda s, d: over_postings(s, d, company=text.na_to_null(c("company")), date_posted_raw=text.na_to_null(c("date_posted_raw"))
    ),
    "filter_has_url": lambda s, d: filter_has_url(
        inputs.postings(s, d).withColumn(
            "job_url", F.when(c("doc_id") % 4 == 0, "").when(c("doc_id") % 4 == 1, c("job_url"))
        )
    ).select("doc_id", "job_url"),
    "gate_description": gate_description,
    "gate_skills": gate_skills,
    "reject_rows": reject_rows,
    "hash_content": lambda s, d: inputs.table(s, d, "documents").select(
        "doc_id", text.hash_content(c("text")).alias("sha"), text.hash_content(c("text"), "md5").alias("md5")
    ),
    "hash_description": lambda s, d: over_postings(s, d, hash=text.hash_description(c("description"))),
    "hash_job_url": lambda s, d: over_postings(s, d, hash=text.hash_job_url(text.strip_query(c("job_url")))),
    "hash_company_url": lambda s, d: over_postings(s, d, hash=text.hash_company_url(text.strip_query(c("company_url")))),
    "job_id16": lambda s, d: over_postings(s, d, job_id=text.job_id16(c("job_url"))),
    "normalize_title": lambda s, d: over_postings(s, d, normalized_title=title.normalize_title(c("raw_title"))),
    "title_keywords": lambda s, d: over_postings(s, d, keywords=joined(title.title_keywords(c("raw_title")))),
    "keep_order_distinct": keep_order_distinct,
    "find_skills": find_skills,
    "sort_skills": lambda s, d: over_postings(s, d, skills=joined(skills.skill_union(skills.find_skills(c("raw_title")), F.array(F.lit("Zeta"), F.lit("alpha"))))
    ),
    "skill_union": lambda s, d: over_postings(s, d, skills=joined(
            skills.skill_union(skills.find_skills(c("raw_title")), skills.find_skills(c("description")))
        )
    ),
    "split_paragraphs": split_paragraphs,
    "section_label": section_label,
    "section_state": section_state,
    "extract_skills": extract_skills,
    "skill_sets": skill_sets,
    "vocab_match": vocab_match,
    "first_match": lambda s, d: over_postings(s, d, family=F.coalesce(
            text.bind(F.lower("raw_title"), lambda t: matching.first_match(t, rules.TITLE_RULES)),
            F.lit("none"),
        )
    ),
    "role_score": role_score,
    "role_type": role_type,
    "seniority": seniority,
    "max_rank": lambda s, d: over_postings(s, d, rank=text.bind(
            F.lower("raw_title"),
            lambda t: matching.max_rank(t, rules.SENIORITY_TITLE, rules.SENIORITY_LEVELS),
        )
    ),
    "years_bucket": lambda s, d: over_postings(s, d, level=dates.years_bucket((c("doc_id") % 103).cast("int")),
        rank=seniority_rank(dates.years_bucket((c("doc_id") % 103).cast("int"))).cast("int"),
    ),
    "experience": experience,
    "employment_type": lambda s, d: over_postings(s, d, employment_type=roles.employment_type(c("description"), c("employment_type_raw"))
    ),
    "work_mode": lambda s, d: over_postings(s, d, work_mode=roles.work_mode(c("description"), c("raw_location"))),
    "normalize_date": lambda s, d: over_postings(s, d, "date_posted_raw", day=dates.normalize_date(c("date_posted_raw"), c("scrape_timestamp")).cast("string")
    ),
    "parse_location": parse_location,
    "state_lookup": lambda s, d: over_postings(s, d, state=location.state_lookup(last_part())),
    "country_member": lambda s, d: over_postings(s, d, known=location.country_member(last_part())),
    "json_valid": json_valid,
    "json_first_block": first_block,
}
