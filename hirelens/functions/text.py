"""Trimming, hashing, ids and URL clean-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# everything that counts as white space at the ends of a string
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable.

    Inside a lambda an outer expression is evaluated per element; bound like this it is not.
    """
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Trim white space of every kind (``trim`` alone takes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def na_to_null(c: Column) -> Column:
    """Exactly ``N/A`` becomes null; other spellings stay."""
    return F.nullif(c, F.lit("N/A"))


def hash_content(c: Column, algorithm: str = "sha256") -> Column:
    """Hex digest of the stripped text; null for null or blank text."""
    body = F.nullif(strip(c), F.lit(""))
    if algorithm == "sha256":
        return F.sha2(body, 256)
    if algorithm == "md5":
        return F.md5(body)
    raise ValueError(f"unsupported hash algorithm: {algorithm}")


# the same hash under the names of the fields it is used on
hash_description = hash_company_about = hash_job_url = hash_company_url = hash_content


def job_id16(url: Column) -> Column:
    """Short id of a parsed posting: 16 hex digits of the lower-cased URL's hash."""
    return F.substring(F.sha2(F.lower(strip(url)), 256), 1, 16)


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def company_about_url(url: Column) -> Column:
    """Address of a company's about page; ``''`` where there is no company address."""
    base = strip_query(url)
    about = F.when(base.contains("/about"), base).otherwise(
        F.concat(F.rtrim(base, F.lit("/")), F.lit("/about/"))
    )
    return F.when(is_blank(url), F.lit("")).otherwise(about)


def keyword_slug(c: Column) -> Column:
    return F.translate(F.lower(c), " /", "__")
