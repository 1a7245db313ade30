"""Near duplicates by SimHash: a segment-popcount embedding searched by a grid range join.

A fingerprint becomes the vector of the bit counts of its segments. Flipping one bit moves one
coordinate by one, so the Manhattan distance of two vectors is a lower bound of the Hamming
distance of the fingerprints. Two vectors within distance 2 have a grid point within distance 1 of
both. Each distinct fingerprint is therefore posted in its own grid cell and the cells one step
away, fingerprints that share a cell are candidates, and the exact Hamming distance decides.

Only distinct fingerprints are searched, so copies cost nothing there, and a fingerprint has at
most 64 + 64 * 63 / 2 others within 2 bits: links stay linear in the rows, whatever the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import blocks, checkpoints, words
from hirelens.operators.near_dup import connected_groups
from hirelens.operators.skew import lookup

SEED = 42
CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text, unsigned: bit set where over half the shingle hashes have it set."""
    tokens = words(text.translate(ASCII_LOWER) if text else text)
    if not tokens:
        return 0
    if len(tokens) < shingle:
        grams: Iterator[bytes] = iter([b" ".join(tokens)])
        count = 1
    else:
        grams = map(b" ".join, zip(*(tokens[i:] for i in range(shingle))))
        count = len(tokens) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, count)
    totals = np.zeros(64, np.int64)
    for start in range(0, count, CHUNK):
        part = hashes[start : start + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        totals += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * totals > count, bitorder="little").view("<u8")[0])


ASCII_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def fingerprints(df: DataFrame, key: str, text: str, shingle: int = 3) -> DataFrame:
    """``key, fp`` (the fingerprint as a signed long) for every row of ``df``.

    Texts that are null or have no word get fingerprint zero.
    """

    def run(batches):
        for block in blocks(batches, "text"):
            values = [fingerprint(t, shingle) for t in block.column("text").to_pylist()]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield from block.select(["key"]).append_column("fp", fps).to_batches()

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fp bigint").withColumnRenamed("key", key)


def grid_cells(fp: Column, segments: int = 16) -> Column:
    """Cells of a fingerprint: its segment bit counts as one number, and all grid points one step away.

    With 16 segments a coordinate takes 0 to 4 and 3 bits; a point has up to 33 cells.
    """
    width = 64 // segments
    field = max(1, width.bit_length())
    if segments * field > 63:
        raise ValueError(f"{segments} segments do not fit a cell number")
    mask = (1 << width) - 1
    counts = [
        F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit(mask).cast("bigint")))
        for i in range(segments)
    ]
    home = sum((c.cast("bigint") * F.lit(1 << (i * field)) for i, c in enumerate(counts)), F.lit(0))
    steps = [F.lit(0).cast("bigint")]
    for i, c in enumerate(counts):
        steps.append(F.when(c < width, F.lit(1 << (i * field)).cast("bigint")))
        steps.append(F.when(c > 0, F.lit(-(1 << (i * field))).cast("bigint")))
    return F.transform(F.array_compact(F.array(*steps)), lambda s: s + home)


def links(distinct: DataFrame, fp: str = "fp", bits: int = 2, segments: int = 16) -> DataFrame:
    """``src, dst``: pairs of distinct fingerprints that differ in at most ``bits`` (0 to 2) bits."""
    if not 0 <= bits <= 2:
        raise ValueError("cells one step away find fingerprints within 2 bits")
    posted = distinct.select(
        F.col(fp).alias("a"), F.explode(grid_cells(F.col(fp), segments)).alias("cell")
    )
    other = posted.select(F.col("a").alias("b"), F.col("cell").alias("other"))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # postings are many times what Spark takes them for, which is the size of the fingerprints
    met = posted.join(
        other.hint("merge"), (F.col("cell") == F.col("other")) & (F.col("a") > F.col("b")) & (differing <= bits)
    )
    return met.select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()


def near_duplicates(
    df: DataFrame, key: str, text: str, shingle: int = 3, bits: int = 2, segments: int = 16
) -> DataFrame:
    """``key, fingerprint, component_id`` for every row of ``df``.

    ``component_id`` is the smallest key reachable over links, the row's own included. Null texts
    and texts without a word have fingerprint zero and link like any other. Rows with a null key
    take part; their component is the smallest key that is not null, null if there is none.
    Repeated rows come back repeated. An empty table gives an empty result.
    """
    checkpoints(df.sparkSession)
    rows = fingerprints(df, key, text, shingle).checkpoint()
    distinct = rows.groupBy("fp").agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = connected_groups(links(distinct.select("fp"), bits=bits, segments=segments))
    placed = distinct.join(groups.hint("merge"), F.col("fp") == F.col("node"), "left").select(
        "fp", "_n", "_first", "group"
    )
    smallest = (
        placed.filter(F.col("group").isNotNull())
        .groupBy("group")
        .agg(F.min("_first").alias("_smallest"), F.count(F.lit(1)).alias("_members"))
    )
    classes = lookup(placed, smallest, "group", "_members").select(
        "fp", "_n", F.coalesce("_smallest", "_first").alias("component_id")
    )
    return lookup(rows, classes, "fp", "_n").select(
        key,
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
