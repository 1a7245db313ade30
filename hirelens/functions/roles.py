"""Role type, seniority, years of experience, employment type and work mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.dates import years_bucket
from hirelens.functions.matching import first_match, hit_count, max_rank, string_array
from hirelens.functions.text import bind, is_blank, strip


def _lower(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def _core_and_optional(low: Column, markers) -> Column:
    """Text before and from the first marker on."""
    start = F.least(*[F.nullif(F.instr(low, m), F.lit(0)) for m in markers], F.length(low) + 1)
    return bind(
        start,
        lambda s: F.struct(
            F.substring(low, F.lit(1), s - 1).alias("core"),
            F.substring(low, s, F.length(low)).alias("optional"),
        ),
    )


def role_scores(
    title: Column,
    description: Column,
    tools: Column,
    signals=rules.ROLE_SIGNALS,
    role_tools=rules.ROLE_TOOLS,
    markers=rules.OPTIONAL_MARKERS,
    weights=rules.ROLE_WEIGHTS,
) -> Column:
    """``array<struct(score, priority, role)>``, one entry per role in table order.

    A keyword counts once each for the title, the core text and the optional text, with a weight
    for each place; tools of a role add to its score.
    """

    def scored(t: Column) -> Column:
        entries = []
        for priority, (role, keywords) in enumerate(signals):
            score = (
                weights["title"] * hit_count(t["title"], keywords)
                + weights["core"] * hit_count(t["body"]["core"], keywords)
                + weights["optional"] * hit_count(t["body"]["optional"], keywords)
            )
            if role in role_tools:
                held = F.size(F.array_intersect(tools, string_array(role_tools[role])))
                score = score + weights["tool"] * F.coalesce(F.greatest(held, F.lit(0)), F.lit(0))
            entries.append(
                F.struct(
                    score.cast("double").alias("score"),
                    F.lit(-priority).alias("priority"),
                    F.lit(role).alias("role"),
                )
            )
        return F.array(*entries)

    body = bind(_lower(description), lambda low: _core_and_optional(low, markers))
    return bind(F.struct(_lower(title).alias("title"), body.alias("body")), scored)


def role_type(title: Column, description: Column, tools: Column, **tables) -> Column:
    """Role with the highest score, earlier table row on ties, ``Unknown`` without any hit."""
    best = bind(role_scores(title, description, tools, **tables), F.array_max)
    return bind(
        best, lambda b: F.when(b["score"] > 0, b["role"]).otherwise(F.lit(rules.UNKNOWN))
    )


def seniority(
    title: Column,
    description: Column,
    years: Column,
    title_words=rules.SENIORITY_TITLE,
    verbs=rules.SENIORITY_VERBS,
    buckets=rules.SENIORITY_YEARS,
    levels=rules.SENIORITY_LEVELS,
) -> Column:
    """Most senior level that the title, the years or the description speak of."""
    from_years = F.array_position(string_array(levels), years_bucket(years, buckets)) - 1
    rank = F.greatest(
        bind(_lower(title), lambda t: max_rank(t, title_words, levels)),
        bind(_lower(description), lambda d: max_rank(d, verbs, levels)),
        from_years.cast("int"),
    )
    return F.coalesce(F.get(string_array(levels), rank), F.lit(rules.UNKNOWN))


def experience(
    description: Column,
    patterns=rules.EXPERIENCE_PATTERNS,
    mention=rules.YEARS_MENTION,
) -> Column:
    """``struct(min_years_experience, experience_text)``.

    The number comes from the first pattern that matches. The text is the first sentence that
    names years. It is cut out around the first mention instead of letting a leading
    ``[^\\n.]*`` run from every position, which is quadratic on long lines.
    """
    years = F.coalesce(
        *[F.regexp_extract(description, f"(?iU){p}", 1).try_cast("int") for p in patterns]
    )
    before = F.regexp_extract(description, rf"(?isU)^(.*?){mention}", 1)
    sentence_tail = F.substring_index(F.translate(before, ".", "\n"), "\n", -1)
    start = F.length(before) - F.length(sentence_tail) + 1
    sentence = F.regexp_extract(
        F.substring(description, start, F.length(description)),
        rf"(?iU)^[^\n.]*(?:{mention})[^\n.]*[.\n]?",
        0,
    )
    text = F.when(description.rlike(f"(?iU){mention}"), strip(sentence))
    return F.when(
        ~is_blank(description),
        F.struct(years.alias("min_years_experience"), text.alias("experience_text")),
    ).otherwise(
        F.struct(
            F.lit(None).cast("int").alias("min_years_experience"),
            F.lit(None).cast("string").alias("experience_text"),
        )
    )


def employment_type(
    description: Column, page_value: Column, rule_table=rules.EMPLOYMENT_RULES
) -> Column:
    """From the page's own field if it says anything, else from the description."""
    return F.coalesce(
        bind(_lower(page_value), lambda t: first_match(t, rule_table)),
        bind(_lower(description), lambda t: first_match(t, rule_table)),
        F.lit(rules.UNKNOWN),
    )


def work_mode(description: Column, location: Column, rule_table=rules.WORK_MODE_RULES) -> Column:
    text = F.concat_ws(" ", F.coalesce(description, F.lit("")), F.coalesce(location, F.lit("")))
    return F.coalesce(
        bind(F.lower(text), lambda t: first_match(t, rule_table)), F.lit(rules.UNKNOWN)
    )
