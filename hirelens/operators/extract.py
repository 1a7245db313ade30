"""Fields from parsed pages by tables of selectors.

A selector is a row ``(tag, attribute, value)``. For each only the first element on the page counts.
A cascade takes the first selector whose element qualifies; ``coalesce`` stops there. Everything is a
narrow projection over the arrays that ``parse_pages`` made: no explode, no shuffle.

The expressions are built as SQL text, because a table of selectors makes many of them and one
parse is far quicker than a call per operator.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.embedded_json import first_block, json_valid
from hirelens.functions.matching import sql_string
from hirelens.functions.text import strip
from hirelens.operators.html import parse_pages

Selector = tuple[str, str, str]


# --- SQL fragments ----------------------------------------------------------------------------


def _matches(e: str, selector: Selector) -> str:
    """A class selector hits when the element has that class; one with spaces, and any other
    attribute, must equal the whole value."""
    tag, attribute, value = selector
    if attribute == "class" and " " not in value:
        hit = f"contains(concat(' ', {e}.cls, ' '), {sql_string(f' {value} ')})"
    elif attribute == "class":
        hit = f"{e}.cls = {sql_string(value)}"
    else:
        hit = f"{e}.attrs[{sql_string(attribute)}] = {sql_string(value)}"
    return f"({e}.tag = {sql_string(tag)} AND {hit})"


def _first(selector: Selector, elements: str = "elements") -> str:
    return f"get(filter({elements}, e -> {_matches('e', selector)}), 0)"


def _inside(outer: str) -> str:
    """Descendants of an element: those that follow it."""
    return f"slice(elements, {outer}.at + 2, {outer}.below)"


def _text(e: str, separator: str = "") -> str:
    return f"array_join(slice(pieces, {e}.piece + 1, {e}.pieces), {sql_string(separator)})"


def _markup(e: str) -> str:
    return f"substring(markup, {e}.start + 1, {e}.length)"


def _with(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _first_of(attempts: Sequence[str]) -> Column:
    return F.expr(f"coalesce({', '.join(attempts)})")


# --- single fields ----------------------------------------------------------------------------


def cascade(selectors: Sequence[Selector], separator: str = "", more_than: int = 0) -> Column:
    """``struct(value, method, html)`` of the first selector whose text is longer than
    ``more_than`` characters; null if there is none."""

    def attempt(i: int, selector: Selector) -> str:
        found = f"named_struct('value', t, 'method', {i}, 'html', {_markup('x')})"
        qualified = f"CASE WHEN length(t) > {more_than} THEN {found} END"
        return _with(_first(selector), "x", _with(_text("x", separator), "t", qualified))

    return _first_of([attempt(i, s) for i, s in enumerate(selectors)])


def with_status(name: str) -> list[Column]:
    """``<name>_raw, <name>_status, <name>_method`` from the cascade in ``_<name>``."""
    found = F.col(f"_{name}")
    return [
        found["value"].alias(f"{name}_raw"),
        F.when(found.isNotNull(), "success").otherwise("not_found").alias(f"{name}_status"),
        found["method"].alias(f"{name}_method"),
    ]


def selector_cascade(
    parsed: DataFrame, name: str, selectors: Sequence[Selector], keys: Sequence[str]
) -> DataFrame:
    """One field with its status and the index of the selector that found it."""
    found = parsed.select(*keys, cascade(selectors).alias(f"_{name}"))
    return found.select(*keys, *with_status(name))


def longest_text(tag: str = rules.FALLBACK_TAG, more_than: int = rules.FALLBACK_MIN_CHARS) -> Column:
    """``struct(value, method)`` of the longest element of a tag, the first of equals; method -1."""
    length = "e.chars + greatest(e.pieces - 1, 0)"
    rank = f"named_struct('n', {length}, 'first', -e.ord, 'piece', e.piece, 'pieces', e.pieces)"
    longest = f"array_max(transform(filter(elements, e -> e.tag = {sql_string(tag)}), e -> {rank}))"
    value = _text("x", "\n")
    found = f"CASE WHEN x.n > {more_than} THEN named_struct('value', {value}, 'method', -1) END"
    return F.expr(_with(longest, "x", found))


def description(selectors=rules.DESCRIPTION_SELECTORS) -> Column:
    """``struct(value, method)``: the cascade, else the longest block."""
    by_selector = cascade(selectors, "\n", rules.DESCRIPTION_MIN_CHARS)
    return F.coalesce(by_selector.dropFields("html"), longest_text())


def description_html(selectors=rules.DESCRIPTION_SELECTORS) -> Column:
    """Markup of the first selector whose element is longer than the limit as markup."""
    enough = f"CASE WHEN x.length > {rules.DESCRIPTION_MIN_CHARS} THEN {_markup('x')} END"
    return _first_of([_with(_first(s), "x", enough) for s in selectors])


def insight(selectors=rules.INSIGHT_SELECTORS) -> Column:
    """``struct(text, html)`` of the first element found, even if its text is empty."""
    element = f"coalesce({', '.join(map(_first, selectors))})"
    found = f"named_struct('text', {_text('x', chr(10))}, 'html', {_markup('x')})"
    return F.expr(_with(element, "x", f"CASE WHEN x IS NOT NULL THEN {found} END"))


def criteria_map(
    item=rules.CRITERIA_ITEM, header=rules.CRITERIA_HEADER, value=rules.CRITERIA_VALUE
) -> Column:
    """Header -> value of the criteria list; of equal headers the last one counts."""
    key = f"replace(lower({_with(_first(header, 'own'), 'h', _text('h'))}), ' ', '_')"
    pair = f"named_struct('key', {key}, 'value', {_with(_first(value, 'own'), 'v', _text('v'))})"
    items = f"filter(elements, li -> {_matches('li', item)})"
    pairs = f"transform({items}, li -> {_with(_inside('li'), 'own', pair)})"
    full = f"filter({pairs}, p -> p.key IS NOT NULL AND p.value IS NOT NULL)"
    placed = f"transform({full}, (p, i) -> named_struct('key', p.key, 'n', -i, 'value', p.value))"
    latest = "filter(ps, (p, i) -> i = 0 OR ps[i - 1].key != p.key)"
    entries = f"transform({latest}, p -> struct(p.key, p.value))"
    return F.expr(_with(f"sort_array({placed})", "ps", f"map_from_entries({entries})"))


def criteria_columns(criteria: Column, columns=rules.CRITERIA_COLUMNS) -> list[Column]:
    return [F.try_element_at(criteria, F.lit(key)).alias(name) for name, key in columns]


def _scripts(test: str) -> Column:
    kind = f"coalesce(e.attrs['type'], '') {test} {sql_string(rules.JSON_LD_TYPE)}"
    own = F.expr(f"filter(elements, e -> e.tag = 'script' AND {kind} AND e.raw != '').raw")
    return F.transform(own, strip)


def json_ld() -> Column:
    """First linked-data script whose text is valid JSON."""
    return F.get(F.filter(_scripts("="), json_valid), F.lit(0))


def job_json(words=rules.JOB_JSON_WORDS) -> Column:
    """First balanced block that is valid JSON, over the other scripts that name job data."""
    about_jobs = F.filter(
        _scripts("!="), lambda s: reduce(lambda a, b: a | b, [s.contains(w) for w in words])
    )
    return F.get(F.filter(F.transform(about_jobs, first_block), json_valid), F.lit(0))


# --- whole pages ------------------------------------------------------------------------------

STATUS_FIELDS = [
    ("salary", rules.SALARY_SELECTORS),
    ("applicant_count", rules.APPLICANT_SELECTORS),
    ("easy_apply_flag", rules.EASY_APPLY_SELECTORS),
    ("remote_label", rules.REMOTE_LABEL_SELECTORS),
    ("posted_by", rules.POSTED_BY_SELECTORS),
]


def _tags(*selector_lists) -> list[str]:
    return sorted({s[0] for selectors in selector_lists for s in selectors})


JOB_TAGS = _tags(
    rules.DESCRIPTION_SELECTORS,
    rules.INSIGHT_SELECTORS,
    rules.LOCATION_SELECTORS,
    *[s for _, s in STATUS_FIELDS],
    [rules.CRITERIA_ITEM, rules.CRITERIA_HEADER, rules.CRITERIA_VALUE],
)
COMPANY_TAGS = _tags(rules.ABOUT_SELECTORS, [rules.INDUSTRY_FALLBACK])
CARD_TAGS = _tags([s for _, s, _ in rules.CARD_FIELDS])


def parse_job_pages(pages: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    return parse_pages(
        pages, keys, tags=JOB_TAGS, attrs=["type"], bare_tags=[rules.FALLBACK_TAG, "script"]
    )


def extract_job_pages(pages: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Every field of a job page, one row per page, successes and failures alike.

    ``success`` is whether a description was found, ``error`` says why not. ``selector_hits``
    counts the field groups found, 0 to 9.
    """
    keys = list(keys)
    found = parse_job_pages(pages, keys).select(
        *keys,
        F.col("elements").isNotNull().alias("_fetched"),
        description().alias("_description"),
        description_html().alias("_description_html"),
        cascade(rules.LOCATION_SELECTORS)["value"].alias("location_from_panel_raw"),
        insight().alias("_insight"),
        *[cascade(s).alias(f"_{name}") for name, s in STATUS_FIELDS],
        criteria_map().alias("page_metadata"),
        json_ld().alias("embedded_json_ld"),
        job_json().alias("embedded_job_json"),
    )
    criteria = criteria_columns(F.col("page_metadata"))
    groups = [
        F.col("_description").isNotNull(),
        F.col("location_from_panel_raw").isNotNull(),
        F.col("_insight").isNotNull(),
        F.col("_salary").isNotNull(),
        F.col("_applicant_count").isNotNull(),
        F.coalesce(*criteria).isNotNull(),
        F.size("page_metadata") > 0,
        F.col("embedded_json_ld").isNotNull(),
        F.col("embedded_job_json").isNotNull(),
    ]
    success = F.col("_description").isNotNull()
    return found.select(
        *keys,
        success.alias("success"),
        F.when(~F.col("_fetched"), rules.FETCH_FAILED)
        .when(~success, rules.DESCRIPTION_FAILED)
        .alias("error"),
        F.col("_description.value").alias("description"),
        F.col("_description_html").alias("description_html"),
        F.col("_description.method").alias("description_extract_method"),
        "location_from_panel_raw",
        F.col("_insight.text").alias("job_insight_section_raw_text"),
        F.col("_insight.html").alias("job_insight_section_raw_html"),
        *[c for name, _ in STATUS_FIELDS for c in with_status(name)],
        "page_metadata",
        *criteria,
        "embedded_json_ld",
        "embedded_job_json",
        F.when(success, reduce(add, [g.cast("int") for g in groups]))
        .otherwise(0)
        .alias("selector_hits"),
    )


def extract_company_pages(pages: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """About text and facts of a company page.

    A fact is a ``dt`` label with the first ``dd`` after it under the same parent; a later label
    of the same fact overwrites an earlier one.
    """
    keys = list(keys)
    named = " ".join(
        f"WHEN contains(label, {sql_string(word)}) THEN {sql_string(field)}"
        for word, field in rules.COMPANY_FACTS
    )
    field = _with(f"lower({_text('dt')})", "label", f"CASE {named} END")
    dd = "CASE WHEN dt.follower >= 0 THEN elements[dt.follower] END"
    value = f"nullif({_with(dd, 'dd', _text('dd'))}, '')"
    facts = (
        "filter(transform(filter(elements, e -> e.tag = 'dt'), dt -> "
        f"named_struct('field', {field}, 'value', {value})), f -> f.value IS NOT NULL)"
    )
    parsed = parse_pages(
        pages,
        keys,
        tags=COMPANY_TAGS,
        attrs=["data-test-id"],
        bare_tags=["dt", "dd"],
        followers={"dt": "dd"},
    )
    found = parsed.select(
        *keys,
        F.col("elements").isNotNull().alias("success"),
        cascade(rules.ABOUT_SELECTORS, "\n", rules.ABOUT_MIN_CHARS).alias("_about"),
        F.expr(facts).alias("_facts"),
        cascade([rules.INDUSTRY_FALLBACK])["value"].alias("_industry"),
    )

    def column(name: str) -> Column:
        value = F.expr(f"try_element_at(filter(_facts, f -> f.field = '{name}'), -1).value")
        if name == "industry":
            value = F.coalesce(value, F.col("_industry"))
        return value.alias(f"company_{name}_raw")

    return found.select(
        *keys,
        "success",
        F.when(~F.col("success"), rules.FETCH_FAILED).alias("error"),
        F.col("_about.value").alias("company_about_raw_text"),
        F.col("_about.html").alias("company_about_raw_html"),
        F.col("_about.method").alias("company_about_method"),
        *[column(name) for _, name in rules.COMPANY_FACTS],
    )


def cards_from_pages(pages: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Listing pages to cards: one row per list item, with its position on the page.

    Each card is first cut down to its own elements, so the fields search a dozen elements and
    not the whole page.
    """

    def field(name: str, selector: Selector, attribute: str | None) -> str:
        if attribute is None:
            value = _text("x")
        else:
            value = f"nullif(x.attrs['{attribute}'], '')"
            value = f"substring_index({value}, '?', 1)" if attribute == "href" else value
        return f"'{name}', {_with(_first(selector, 'own'), 'x', value)}"

    card = f"named_struct({', '.join(field(*f) for f in rules.CARD_FIELDS)})"
    cards = (
        f"transform(filter(elements, e -> e.tag = '{rules.CARD_TAG}'), "
        f"li -> {_with(_inside('li'), 'own', card)})"
    )
    return (
        parse_pages(
            pages,
            keys,
            tags=CARD_TAGS,
            attrs=["href", "datetime"],
            bare_tags=[rules.CARD_TAG],
            markup=False,
        )
        .select(*keys, F.posexplode(F.expr(cards)).alias("card", "_card"))
        .select(*keys, "card", "_card.*")
    )
