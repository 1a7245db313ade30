"""All registered queries and their SQL."""

from __future__ import annotations

from hirelens.plans import (
    archive_oracles,
    archive_queries,
    market_oracles,
    market_queries,
    page_oracles,
    page_queries,
    parse_oracles,
    parse_queries,
)


def queries() -> dict:
    return {
        **parse_queries.QUERIES,
        **page_queries.QUERIES,
        **archive_queries.QUERIES,
        **market_queries.QUERIES,
    }


def oracles() -> dict[str, str]:
    return {
        **parse_oracles.ORACLES,
        **page_oracles.ORACLES,
        **archive_oracles.ORACLES,
        **market_oracles.ORACLES,
    }
