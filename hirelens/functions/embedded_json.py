"""JSON text inside pages: validity, and the first balanced block of a script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.text import bind


def json_valid(text: Column) -> Column:
    """Whether ``text`` is one JSON value; repeated keys and ``NaN`` or ``Infinity`` are allowed.

    The text is read as the first of two array elements, so that nothing may stand behind it.
    """
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true", "mode": "PERMISSIVE"}
    wrapped = F.concat(F.lit("["), text, F.lit(',"end"]'))
    parts = F.from_json(wrapped, "array<string>", options)
    whole = (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == "end")
    return F.coalesce(whole & (F.trim(text) != ""), F.lit(False))


def first_block(text: Column) -> Column:
    """From the first ``{`` or ``[`` to the bracket that brings the depth back to zero.

    Brackets are counted without regard to kind or to quoted strings. Null if there is no
    opening bracket or it never closes. The text is cut behind each closing bracket, so the fold
    takes one step per closing bracket, not per character.
    """
    opened = F.regexp_extract(text, r"(?s)[{\[].*$", 0)
    pieces = F.split(opened, r"(?<=[}\]])")

    def step(acc: Column, piece: Column) -> Column:
        closes = F.when(piece.rlike(r"[}\]]$"), 1).otherwise(0)
        opens = F.length(piece) - F.length(F.translate(piece, "{[", ""))
        depth = acc["depth"] + opens - closes
        return F.when(acc["done"], acc).otherwise(
            F.struct(
                depth.alias("depth"),
                (acc["used"] + 1).alias("used"),
                ((closes == 1) & (depth == 0)).alias("done"),
            )
        )

    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("used"), F.lit(False).alias("done")
    )
    return bind(
        pieces,
        lambda ps: bind(
            F.aggregate(ps, start, step),
            lambda end: F.when(
                end["done"], F.array_join(F.slice(ps, F.lit(1), end["used"]), "")
            ),
        ),
    )
