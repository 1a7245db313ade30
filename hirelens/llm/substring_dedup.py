"""Removal of repeated passages by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the smallest hash among the runs of
``seed`` words inside it, so equal windows have equal minimisers, and consecutive windows mostly
share one: such a stretch is a super-k-mer. Windows can only repeat across documents where their
minimiser does. The steps:

1. Each text gives its super-k-mers as (minimiser, first window, windows), without words.
2. Minimisers seen in one document only are dropped: no window of theirs is in two documents.
3. The other super-k-mers travel as one packed string each, equal strings folded into one with
   their smallest document, to the bucket of their minimiser. There the strings are opened into
   windows, which are sorted and counted: each distinct window learns the smallest document it
   starts in. Windows are told apart by 128 bits of SHA-256.
4. The smallest documents go back to the super-k-mers of each document, which say what to remove.

A bucket with more than ``PART`` distinct strings (a passage that a large share of the texts quotes,
each in its own context) is not brought together: its windows are counted by digest, combined before
the shuffle. No task holds a bucket that grows with the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hirelens.llm.common import blocks, checkpoints, stored, words
from hirelens.operators.skew import HOT_KEYS, lookup

WINDOW = 50
SEED_WORDS = 12
PART = 2000  # distinct strings that a bucket may have to be counted in one piece
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def smallest_in(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def super_kmers(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """``minimiser, first window, windows`` of one text, given the hashes of its words.

    A stretch ends where the minimiser changes and after ``window`` windows at most, so a packed
    string has under ``2 * window`` words even where a text repeats one word.
    """
    if len(hashes) < window:
        return (np.empty(0, np.uint64),) + (np.empty(0, np.int32),) * 2
    with np.errstate(over="ignore"):
        runs = hashes[: len(hashes) - seed + 1].copy()
        for i in range(1, seed):
            runs = runs * MULTIPLIER + hashes[i : len(hashes) - seed + 1 + i]
        runs ^= runs >> np.uint64(32)
        runs *= MIX
        runs ^= runs >> np.uint64(29)
    low = smallest_in(runs, window - seed + 1)
    edges = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    sizes = np.diff(np.append(edges, len(low)))
    if sizes.max() > window:
        parts = -(-sizes // window)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        edges, sizes = np.repeat(edges, parts) + nth * window, np.repeat(sizes, parts)
        sizes = np.minimum(window, sizes - nth * window)
    return low[edges], edges.astype(np.int32), sizes.astype(np.int32)


def word_hashes(tokens: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    for w in set(tokens).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def find_super_kmers(rows: DataFrame, kind: str, window: int, seed: int) -> DataFrame:
    """``key, copy, minimiser, first, n`` for ``rows`` of ``key, copy, text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for block in blocks(batches, "text"):
            if len(known) > 200_000:
                known.clear()
            texts = block.column("text").to_pylist()
            found = [super_kmers(word_hashes(words(t), known), window, seed) for t in texts]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            low, first, n = (np.concatenate([f[i] for f in found]) for i in range(3))
            taken = block.select(["key", "copy"]).take(owner)
            taken = taken.append_column("minimiser", pa.array(low.view(np.int64)))
            taken = taken.append_column("first", pa.array(first)).append_column("n", pa.array(n))
            yield from taken.to_batches()

    return rows.mapInArrow(run, f"key {kind}, copy bigint, minimiser bigint, first int, n int")


def pack(rows: DataFrame, kind: str, window: int) -> DataFrame:
    """``key, copy, minimiser, first, string, packed`` for rows of ``key, copy, text, spans``.

    ``string`` is a digest that names the packed words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            owner, minimiser, first, string, packed = [], [], [], [], []
            texts, spans = (block.column(c).to_pylist() for c in ("text", "spans"))
            for i, text in enumerate(texts):
                tokens = words(text)
                for span in spans[i]:
                    cut = b" ".join(tokens[span["first"] : span["first"] + span["n"] + window - 1])
                    owner.append(i)
                    minimiser.append(span["minimiser"])
                    first.append(span["first"])
                    string.append(hashlib.sha256(cut).digest()[:16])
                    packed.append(cut)
            taken = block.select(["key", "copy"]).take(pa.array(owner, pa.int64()))
            for name, values, of in (
                ("minimiser", minimiser, pa.int64()),
                ("first", first, pa.int32()),
                ("string", string, pa.binary()),
                ("packed", packed, pa.binary()),
            ):
                taken = taken.append_column(name, pa.array(values, of))
            yield from taken.to_batches()

    return rows.mapInArrow(
        run,
        f"key {kind}, copy bigint, minimiser bigint, first int, string binary, packed binary",
    )


def windows_of(packed: bytes, window: int) -> list[bytes]:
    """The windows of a packed string, in order."""
    starts, at = [0], packed.find(b" ")
    while at >= 0:
        starts.append(at + 1)
        at = packed.find(b" ", at + 1)
    starts.append(len(packed) + 1)
    return [packed[starts[i] : starts[i + window] - 1] for i in range(len(starts) - window)]


def count_bucket(strings: list[tuple[bytes, object]], window: int) -> list[list]:
    """For each ``(packed, key)`` of a bucket: the smallest key that each of its windows starts in."""
    opened = [windows_of(packed, window) for packed, _ in strings]
    rows = [(w, i, p) for i, found in enumerate(opened) for p, w in enumerate(found)]
    rows.sort(key=itemgetter(0))
    lows: list[list] = [[None] * len(found) for found in opened]
    for _, equal in groupby(rows, key=itemgetter(0)):
        group = list(equal)
        low = min(strings[i][1] for _, i, _ in group)
        for _, i, p in group:
            lows[i][p] = low
    return lows


def count_small_buckets(strings: DataFrame, kind: str, window: int) -> DataFrame:
    """``string, lows`` for buckets of at most ``PART`` strings, one bucket in memory at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in range(4)))

        for _, bucket in groupby(rows(), key=itemgetter(0)):
            held = list(bucket)
            lows = count_bucket([(packed, key) for _, _, packed, key in held], window)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[1] for r in held], pa.binary()), pa.array(lows, pa.list_(wire))],
                names=["string", "lows"],
            )

    wire = to_arrow_type(strings.schema["key"].dataType)
    dealt = strings.select("minimiser", "string", "packed", "key")
    dealt = dealt.repartition("minimiser").sortWithinPartitions("minimiser")
    return dealt.mapInArrow(run, f"string binary, lows array<{kind}>")


def count_large_buckets(strings: DataFrame, kind: str, window: int) -> DataFrame:
    """``string, lows`` for the other buckets: windows are told apart by 128 bits of SHA-256 and
    counted by an aggregate that combines before its shuffle, so no task holds a bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "packed", 500_000):
            opened = [windows_of(p, window) for p in block.column("packed").to_pylist()]
            owner = np.repeat(np.arange(len(opened)), [len(o) for o in opened])
            taken = block.select(["string", "key"]).take(pa.array(owner))
            place = [p for o in opened for p in range(len(o))]
            digest = [hashlib.sha256(w).digest()[:16] for o in opened for w in o]
            taken = taken.append_column("place", pa.array(place, pa.int32()))
            taken = taken.append_column("digest", pa.array(digest, pa.binary()))
            yield from taken.to_batches()

    opened = strings.select("string", "packed", "key").mapInArrow(
        run, f"string binary, key {kind}, place int, digest binary"
    )
    opened = stored(opened, "windows")
    lows = opened.groupBy("digest").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("_n"))
    placed = lookup(opened, lows.filter("_n > 1"), "digest", "_n", grows=True)
    ordered = F.array_sort(
        F.collect_list(F.struct("place", F.coalesce("low", "key").alias("low")))
    )
    return placed.groupBy("string").agg(ordered["low"].alias("lows"))


def of_minimisers(kmers: DataFrame, shared: DataFrame) -> DataFrame:
    """The super-k-mers with one of the ``shared`` minimisers (``minimiser, _n``).

    The most frequent ones, a bounded number, are told by a broadcast and need no shuffle; any other
    has less than a thousandth of the rows. ``kmers`` is a written table, so reading it twice is cheap.
    """
    hot = F.broadcast(shared.orderBy(F.desc("_n"), "minimiser").limit(HOT_KEYS).select("minimiser"))
    rest = kmers.join(hot, "minimiser", "left_anti")
    return kmers.join(hot, "minimiser", "left_semi").unionByName(
        rest.join(shared.hint("merge"), "minimiser", "left_semi")
    )


def repeated_windows(
    df: DataFrame, key: str, text: str, window: int = WINDOW, seed: int = SEED_WORDS
) -> DataFrame:
    """``key, copy, starts``: for each row with any, the places (first words) of its windows that
    also start in a row with a smaller key. ``copy`` is the hash of the text; it tells apart rows
    that share a key. Rows without a key or with fewer than ``window`` words do not appear."""
    spark = df.sparkSession
    checkpoints(spark)
    kind = df.schema[key].dataType.simpleString()
    rows = df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("copy"), F.col(text).alias("text")
    )
    kmers = stored(find_super_kmers(rows, kind, window, seed), "super-kmers")
    shared = (
        kmers.groupBy("minimiser")
        .agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("_n"))
        .filter("lo < hi")
        .select("minimiser", "_n")
    )
    shared = stored(shared, "shared-minimisers")
    wanted = of_minimisers(kmers, shared)
    spans = wanted.groupBy("key", "copy").agg(
        F.collect_set(F.struct("minimiser", "first", "n")).alias("spans")
    )
    packed = stored(pack(rows.join(spans.hint("merge"), ["key", "copy"]), kind, window), "packed")
    strings = packed.groupBy("minimiser", "string").agg(
        F.min("key").alias("key"), F.first("packed").alias("packed")
    )
    strings = stored(strings, "strings")
    sizes = strings.groupBy("minimiser").agg(F.count(F.lit(1)).alias("_n"))
    over = stored(sizes.filter(F.col("_n") > PART), "large-buckets")
    small = count_small_buckets(strings.join(over, "minimiser", "left_anti"), kind, window)
    large = count_large_buckets(strings.join(over, "minimiser", "left_semi"), kind, window)
    met = packed.groupBy("string").agg(F.count(F.lit(1)).alias("_n"))
    lows = stored(small.unionByName(large).join(met.hint("merge"), "string"), "lows")
    # lists of equal numbers are far smaller as files than as rows
    placed = lookup(packed.select("key", "copy", "first", "string"), lows, "string", "_n", grows=True)
    starts = F.filter(
        F.transform("lows", lambda low, i: F.when(low < F.col("key"), F.col("first") + i)),
        lambda at: at.isNotNull(),
    )
    found = placed.select("key", "copy", starts.alias("at")).filter(F.size("at") > 0)
    return found.groupBy("key", "copy").agg(F.flatten(F.collect_set("at")).alias("starts"))


def remove_repeats(
    df: DataFrame, key: str, text: str, window: int = WINDOW, seed: int = SEED_WORDS
) -> DataFrame:
    """All columns of ``df`` with ``_n_words, _n_removed, _kept`` behind them.

    A word goes if it lies in a window whose words also start a window of a row with a smaller key;
    windows are judged on the input. ``_kept`` joins the words that stay with one space each.
    A null text has no words and an empty ``_kept``. A row with a null key loses nothing and makes
    nobody else lose anything. Rows that share a key do not make each other lose words. Repeated
    rows come back repeated.
    """
    starts = repeated_windows(df, key, text, window, seed).select(
        F.col("key").alias("_key"), F.col("copy").alias("_copy"), F.col("starts").alias("_starts")
    )
    rows = df.withColumn("_row_copy", F.xxhash64(text))
    marked = rows.join(
        starts.hint("merge"), (F.col(key) == F.col("_key")) & (F.col("_row_copy") == F.col("_copy")), "left"
    ).drop("_key", "_copy", "_row_copy")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            counts, removed, kept = [], [], []
            places = block.column("_starts").to_pylist()
            for value, at in zip(block.column(text).to_pylist(), places):
                tokens = words(value)
                counts.append(len(tokens))
                if at:
                    cover = np.zeros(len(tokens) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, np.array(at) + window, -1)
                    stay = np.cumsum(cover[:-1]) == 0
                    tokens = [w for w, s in zip(tokens, stay.tolist()) if s]
                removed.append(counts[-1] - len(tokens))
                kept.append(b" ".join(tokens).decode())
            out = block.drop_columns(["_starts"])
            out = out.append_column("_n_words", pa.array(counts, pa.int64()))
            out = out.append_column("_n_removed", pa.array(removed, pa.int64()))
            yield from out.append_column("_kept", pa.array(kept, pa.string())).to_batches()

    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("_n_words", T.LongType()),
            T.StructField("_n_removed", T.LongType()),
            T.StructField("_kept", T.StringType()),
        ]
    )
    return marked.select(*df.columns, "_starts").mapInArrow(run, schema)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), firsts AS (
  SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY s) < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + k AS at FROM firsts, range(50) AS r(k)
), kept AS (
  SELECT t.doc_id, count(*) FILTER (g.at IS NOT NULL) AS n_removed,
    coalesce(string_agg(t.word, ' ' ORDER BY t.at) FILTER (g.at IS NULL), '') AS text
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM d) AS t
  LEFT JOIN gone AS g ON g.doc_id = t.doc_id AND g.at = t.at
  GROUP BY t.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
