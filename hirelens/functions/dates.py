"""Posting dates: relative wording and written dates."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.text import is_blank, strip


def normalize_date(raw: Column, reference: Column) -> Column:
    """Date of a posting. ``3 weeks ago`` counts back from ``reference`` (the collection time);
    months are 30 and years 365 days. Null for ``N/A`` and for wording that is no date."""
    pattern = f"(?iU){rules.AGO_PATTERN}"
    days_per_unit = F.create_map(*[F.lit(x) for x in chain.from_iterable(rules.AGO_UNIT_DAYS)])
    unit = F.nullif(F.lower(F.regexp_extract(raw, pattern, 2)), F.lit(""))
    amount = F.regexp_extract(raw, pattern, 1).try_cast("int")
    # nothing before year 1 is a date; the bound also keeps the product inside an int
    days = F.when(amount < 800_000, amount * F.try_element_at(days_per_unit, unit))
    day = F.date_sub(reference.cast("date"), days)
    ago = F.when(day >= F.lit("0001-01-01").cast("date"), day)
    written = F.coalesce(
        *[F.try_to_timestamp(strip(raw), F.lit(f)).cast("date") for f in rules.DATE_FORMATS]
    )
    return (
        F.when(is_blank(raw) | (F.upper(strip(raw)) == "N/A"), F.lit(None).cast("date"))
        .when(unit.isNotNull(), ago)
        .otherwise(written)
    )


def years_bucket(years: Column, buckets=rules.SENIORITY_YEARS) -> Column:
    """Level of a number of years (half-open ranges); null outside all ranges."""
    return F.coalesce(
        *[F.when((years >= low) & (years < high), F.lit(level)) for low, high, level in buckets]
    )
