"""Job titles: canonical form and keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.matching import first_match, quote_regex
from hirelens.functions.text import bind, is_blank, strip


def normalize_title(raw: Column, title_rules=rules.TITLE_RULES) -> Column:
    """Canonical title, or the stripped original when no rule applies."""
    cleaned = strip(
        F.regexp_replace(F.regexp_replace(F.lower(raw), r"(?d)\(.*?\)", ""), r"(?U)\s+", " ")
    )
    matched = bind(cleaned, lambda t: first_match(t, title_rules))
    return F.when(is_blank(raw), F.lit(rules.UNKNOWN)).otherwise(F.coalesce(matched, strip(raw)))


def title_keywords(
    raw: Column,
    keywords=rules.TITLE_KEYWORDS,
    bounded_up_to: int = rules.TITLE_KEYWORD_BOUNDED_UP_TO,
) -> Column:
    """Keywords in the title, in vocabulary order. Short ones must stand alone as a word."""

    def test(low: Column, keyword: str) -> Column:
        if len(keyword) <= bounded_up_to:
            found = low.rlike(rf"(?iU)\b{quote_regex(keyword)}\b")
        else:
            found = low.contains(keyword.lower())
        return F.when(found, F.lit(keyword))

    found = bind(
        F.lower(raw),
        lambda low: F.array_distinct(F.array_compact(F.array(*[test(low, k) for k in keywords]))),
    )
    return F.when(is_blank(raw), F.array().cast("array<string>")).otherwise(found)
