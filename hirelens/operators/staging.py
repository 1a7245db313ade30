"""Columns that must be computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for costly columns that a later filter looks at.

    The optimizer pushes a filter below the projection it refers to and so computes its columns
    again, once per mention. It does not push below a generator, so the columns come out of one
    that gives exactly one row per row.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline_outer(F.array(row)))
