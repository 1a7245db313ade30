"""Rule tables as Column expressions: first hit, all hits, highest rank, hit count."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote_regex(needle: str) -> str:
    """``needle`` as a pattern that matches it literally."""
    return re.sub(r"([^\w\s])", r"\\\1", needle)


def sql_string(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def string_array(values: Iterable[str]) -> Column:
    """Literal ``array<string>``. As one expression: a call per element is slow to build."""
    return F.expr(f"array({', '.join(map(sql_string, values))})").cast("array<string>")


def string_map(pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal ``map<string, string>``."""
    flat = (sql_string(x) for pair in pairs for x in pair)
    return F.expr(f"map({', '.join(flat)})")


def first_match(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Value of the first rule whose substring occurs in ``text``; null if none does.

    ``coalesce`` stops at the first hit, so later rules cost nothing.
    """
    return F.coalesce(*[F.when(text.contains(needle), F.lit(value)) for needle, value in rules])


def hits(text: Column, needles: Sequence[str]) -> Column:
    """The needles that occur in ``text``, in table order.

    ``text`` is read once per needle: pass a column or a bound variable, not an expression.
    """
    return F.filter(string_array(needles), lambda needle: text.contains(needle))


def hit_count(text: Column, needles: Sequence[str]) -> Column:
    return F.size(hits(text, needles))


def max_rank(text: Column, rules: Sequence[tuple[str, str]], order: Sequence[str]) -> Column:
    """Highest rank (position in ``order``) among the rules that occur; null if none does."""
    by_rank = [
        F.when(
            F.exists(string_array(n for n, v in rules if v == level), lambda n: text.contains(n)),
            F.lit(rank),
        )
        for rank, level in enumerate(order)
        if any(v == level for _, v in rules)
    ]
    return F.coalesce(*reversed(by_rank))


def bounded(needle: str) -> str:
    """Pattern for ``needle`` with no ASCII letter on either side."""
    return rf"(?<![a-zA-Z]){quote_regex(needle)}(?![a-zA-Z])"


def bounded_groups(needles: Sequence[str]) -> list[str]:
    """As few patterns as possible that together find every bounded needle in one pass each.

    Needles share a pattern unless one of them occurs bounded inside another, where an
    alternation would report only one of the two.
    """
    groups: list[list[str]] = []
    for needle in needles:
        for group in groups:
            if not any(
                re.search(bounded(a), b) for g in group for a, b in ((g, needle), (needle, g))
            ):
                group.append(needle)
                break
        else:
            groups.append([needle])
    return [
        rf"(?<![a-zA-Z])({'|'.join(quote_regex(n) for n in group)})(?![a-zA-Z])" for group in groups
    ]
