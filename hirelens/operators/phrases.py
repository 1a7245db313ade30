"""Phrases of a large vocabulary in texts.

A vocabulary of a few hundred needles is searched inside the row (``matching``). A large one is joined:
each place of a text asks for the phrases that may begin there, one run of words per length that
phrases have. Runs are first held against a bitmap of all phrases, of a fixed size, where they are
made; only those that it lets through are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.text import bind
from hirelens.operators.skew import lookup

BITS = 20  # cells of the bitmap: 2^20
IN_WORD = 63  # cells in a long, so that none is negative


def cell(phrase: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(phrase), 64 - BITS)


def phrase_bitmap(phrases: DataFrame) -> Column:
    """The bitmap of ``phrase`` as an array of longs, the same in every row."""
    at = cell(F.col("phrase"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % IN_WORD).cast("int"))
    words = phrases.groupBy(F.floor(at / IN_WORD).cast("int").alias("place")).agg(F.bit_or(bit).alias("bits"))
    bits = [0] * ((1 << BITS) // IN_WORD + 1)
    for r in words.collect():  # at most one row per long
        bits[r["place"]] = r["bits"]
    return F.expr(f"array({','.join(f'{b}L' for b in bits)})")  # a call per element is slow to build


def may_be_phrase(run: Column, bitmap: Column) -> Column:
    at = cell(run)
    word = F.get(bitmap, F.floor(at / IN_WORD).cast("int"))
    return F.getbit(word, (at % IN_WORD).cast("int")) == 1


def phrase_hits(df: DataFrame, key: str, tokens: Column, phrases: DataFrame) -> DataFrame:
    """``key, phrase, place``: every place (from 0, in words) where a phrase begins in a row's tokens.

    ``phrases`` has distinct ``phrase``, words with one space between. Hits may overlap. A hit is where
    the phrase stands in the text on word borders: the tokens with spaces around contain it with
    spaces around. Phrases that many texts have are looked up, not shuffled to one task. Null and
    empty token lists and phrases have no hits; rows of ``df`` with equal keys are one text each.
    """
    known = phrases.select("phrase").filter("phrase <> ''").distinct()
    length = F.size(F.split("phrase", " "))
    lengths = sorted(r[0] for r in known.select(length).distinct().collect())  # words of a phrase: few
    bitmap = phrase_bitmap(known)

    def runs(ts: Column, n: int) -> Column:
        places = F.sequence(F.lit(0), F.size(ts) - n)
        at = F.transform(
            places, lambda i: F.struct(i.alias("place"), F.array_join(F.slice(ts, i + 1, F.lit(n)), " ").alias("phrase"))
        )
        return F.when(F.size(ts) >= n, at).otherwise(none)

    none = F.array().cast("array<struct<place:int,phrase:string>>")
    found = bind(tokens, lambda ts: F.concat(none, *[runs(ts, n) for n in lengths]))
    asked = df.select(key, F.inline(found)).filter(may_be_phrase(F.col("phrase"), bitmap))
    counts = asked.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).join(known, "phrase")
    hits = lookup(asked, counts, "phrase", "n").filter("n is not null")
    return hits.select(key, "phrase", "place")
