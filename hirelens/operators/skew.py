"""Joins and rankings that hold up when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

HOT_KEYS = 1000  # keys outside the 1000 most frequent have less than 1/1000 of all rows each
FREQUENT = 20_000  # keys of narrow tables that ``meet`` broadcasts


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: str,
    count: str,
    spread: Sequence[str] | None = None,
    grows: bool = False,
) -> DataFrame:
    """Left join of ``df`` with a ``table`` that has one row per ``key`` and, in ``count``, how
    frequent the key is in ``df``.

    The ``HOT_KEYS`` most frequent keys are looked up in a broadcast of exactly that many rows. All
    other rows go to a shuffled join with the whole table; rows already answered, and rows without a
    key, take a hash of themselves as key there, so they spread instead of meeting in one task. ``df`` is read once.

    ``spread`` names the columns that are hashed, all of them by default. Rows that are equal in all
    of these stay together, so where many can be, fold them first (see ``lemmatize``).
    With ``grows`` the whole table is never broadcast, whatever Spark takes its size for: files of ids or
    lists can be many times as large once they are read.
    """
    values = [c for c in table.columns if c != key]
    hot = table.orderBy(F.desc(count), key).limit(HOT_KEYS)
    hot = hot.select(F.col(key).alias("_hot"), F.struct(*values).alias("_from_hot"))  # null where not met
    cold = table.select(
        F.col(key).cast("string").alias("_cold"), F.struct(*values).alias("_from_cold")
    )
    cold = cold.hint("merge") if grows else cold
    answered = df.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    own_hash = F.concat(F.lit("\0"), F.xxhash64(*(spread or df.columns)).cast("string"))
    # part of the condition and no column, so that rows are not shuffled with their key twice
    probe = F.when(F.col("_from_hot").isNotNull() | F.col(key).isNull(), own_hash).otherwise(
        F.col(key).cast("string")
    )
    joined = answered.join(cold, probe == F.col("_cold"), "left")
    found = F.coalesce("_from_hot", "_from_cold")
    return joined.select(*df.columns, *[found[v].alias(v) for v in values])


def meet(df: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``df`` with a narrow ``table`` that has one row per ``key`` and, in ``count``, how
    frequent the key is in ``df``.

    The ``FREQUENT`` most frequent keys come as a broadcast of exactly that many rows, and rows that it
    answers are not shuffled at all; only the others go to a merge join with the whole table. Both are
    read twice, so they are best written tables.
    """
    frequent = table.orderBy(F.desc(count), key).limit(FREQUENT)
    near = df.join(F.broadcast(frequent), key)
    others = df.join(F.broadcast(frequent.select(key)), key, "left_anti")
    return near.unionByName(others.join(table.hint("merge"), key))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each key by ``order``, with their ``rank``.

    Spark turns the filter on the row number into a limit per key inside each task, before the
    shuffle, so a large key sends ``k`` rows per task and not all of its rows.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= k)


def rank_by_score(df: DataFrame, keys: Sequence[str], score: str, steps: int = 10_000) -> DataFrame:
    """``rank`` of each row within its key by a score in [0, 1], best first, equals share a rank.

    Ranks follow the whole score. It is cut into ``steps`` only to share out the work: rows are
    counted per score, the counts of the steps above come from a window of at most ``steps`` rows per
    key, those of higher scores within a step from a window over the distinct scores of that step.
    Ranks go back by a look-up.
    """
    level = F.to_json(F.struct(*keys, score))
    leveled = df.withColumn("_level", level)
    counts = leveled.groupBy(*keys, score, "_level").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_step", F.floor(F.col(score) * steps))
    per_step = counts.groupBy(*keys, "_step").agg(F.sum("_n").alias("_in_step"))
    before = (Window.unboundedPreceding, -1)
    higher = Window.partitionBy(*keys).orderBy(F.desc("_step")).rowsBetween(*before)
    above = per_step.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_step").alias("_of_step"),
        F.coalesce(F.sum("_in_step").over(higher), F.lit(0)).alias("_above"),
    )
    same = F.col("_step").eqNullSafe(F.col("_of_step"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    within = Window.partitionBy(*keys, "_step").orderBy(F.desc(score)).rowsBetween(*before)
    ahead = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    ranks = ahead.join(above, same).select(
        "_level", "_n", (F.col("_above") + F.col("_ahead") + 1).alias("rank")
    )
    return lookup(leveled, ranks, "_level", "_n").drop("_level", "_n")
