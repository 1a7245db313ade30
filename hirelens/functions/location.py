"""Locations: free text to city, region and country."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.matching import string_array, string_map
from hirelens.functions.text import bind, is_blank, strip


def state_lookup(code: Column, states=rules.US_STATES) -> Column:
    """Full name of a state code in any letter case; null when it is none."""
    return F.try_element_at(string_map(states), F.upper(code))


def country_member(name: Column, countries=rules.COUNTRIES) -> Column:
    return F.array_contains(string_array(countries), F.lower(name))


def parse_location(raw: Column, states=rules.US_STATES, countries=rules.COUNTRIES) -> Column:
    """``struct(city, region, country)``, each null where it cannot be told.

    One part is a country unless it is a state code; of two parts the second is a state, a
    country or a region; of three or more the first three are taken in order.
    """
    null = F.lit(None).cast("string")

    def place(city: Column = null, region: Column = null, country: Column = null) -> Column:
        return F.struct(city.alias("city"), region.alias("region"), country.alias("country"))

    def by_parts(p: Column) -> Column:
        first, second = F.get(p, F.lit(0)), F.get(p, F.lit(1))
        us = F.lit("United States")
        one = F.when(
            ~country_member(first, countries) & state_lookup(first, states).isNotNull(),
            place(region=state_lookup(first, states), country=us),
        ).otherwise(place(country=first))
        two = (
            F.when(
                state_lookup(second, states).isNotNull(),
                place(first, state_lookup(second, states), us),
            )
            .when(country_member(second, countries), place(first, country=second))
            .otherwise(place(first, second))
        )
        more = place(
            first, F.coalesce(state_lookup(second, states), second), F.get(p, F.lit(2))
        )
        return (
            F.when(F.size(p) == 0, place())
            .when(F.size(p) == 1, one)
            .when(F.size(p) == 2, two)
            .otherwise(more)
        )

    text = strip(raw)
    parts = F.filter(F.transform(F.split(text, ","), strip), lambda p: p != "")
    return (
        F.when(is_blank(raw) | (F.upper(text) == "N/A"), place())
        .when(text.rlike(r"(?iU)^remote\b"), place(country=F.lit("Remote")))
        .otherwise(bind(parts, by_parts))
    )
