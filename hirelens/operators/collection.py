"""A collection run as table operations: saved listing, job and company pages in, raw records out.

Fetching pages is not part of this library; they arrive as tables with one row per address.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.text import company_about_url, hash_job_url
from hirelens.operators.extract import cards_from_pages, extract_company_pages, extract_job_pages
from hirelens.operators.history import dedup_jobs, limit_listings, skip_seen
from hirelens.operators.records import (
    build_raw_company,
    build_raw_job,
    fetched,
    filter_has_url,
    gate_success,
)


def new_cards(
    listing_pages: DataFrame,
    archive: DataFrame | None = None,
    limit: int | None = None,
    page: str = "page_id",
) -> DataFrame:
    """Cards with an address, each job once, without jobs of the archive; the first ``limit`` in
    page order when one is given, counted after the others are gone."""
    cards = cards_from_pages(listing_pages, [page]).transform(filter_has_url)
    if archive is not None:
        cards = skip_seen(cards, archive)
    keyed = cards.withColumn("job_id_raw", hash_job_url(F.col("job_url")))
    once = dedup_jobs(keyed, "job_id_raw", (page, "card"))
    return once if limit is None else limit_listings(once, limit, (page, "card"))


def with_job_pages(cards: DataFrame, job_pages: DataFrame, url: str = "url") -> DataFrame:
    """Cards with all fields of their job page, successes and failures. ``gate_success`` and
    ``reject_rows`` split it; write it first when both are wanted, or pages are parsed twice."""
    return fetched(cards, extract_job_pages(job_pages, [url]), url)


def collect_jobs(
    cards: DataFrame, job_pages: DataFrame, run_ts: Column, keyword: str = "", location: str = ""
) -> DataFrame:
    """Raw job records of one run."""
    kept = with_job_pages(cards, job_pages).transform(gate_success)
    return build_raw_job(kept, run_ts, keyword, location)


def collect_companies(
    cards: DataFrame,
    company_pages: DataFrame,
    run_ts: Column,
    url: str = "url",
    names: Sequence[str] = ("company_url", "company"),
) -> DataFrame:
    """Raw company records of one run: one per company address on the cards whose about page is
    there. Pages are keyed by the address of the about page."""
    address, name = names
    targets = (
        cards.filter(F.col(address).isNotNull())
        .groupBy(F.col(address).alias("company_url"))
        .agg(F.min(name).alias("company_name"))
        .withColumn("_about", company_about_url(F.col("company_url")))
    )
    pages = extract_company_pages(company_pages, [url]).filter("success")
    found = targets.join(pages, F.col("_about") == F.col(url))
    return build_raw_company(found, run_ts)
