"""Best-fit decreasing of whole documents into sequences of a fixed length.

Pieces of equal length are interchangeable, so the packing of any number of documents follows from
how many pieces there are of each length, at most ``limit`` numbers. On these the driver runs best
fit decreasing exactly, a whole run of equal pieces at a time: a segment tree over the remaining
capacities gives the tightest open bins for a length in logarithmic time. The result is a list of
runs whose length depends on ``limit`` alone. Tasks then place each piece by its number among the
pieces of its length. No text, token or piece is gathered anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from hirelens.llm.common import blocks, checkpoints, stored
from hirelens.llm.token_ids import BLOCK_BYTES, encoder

LIMIT = 2048


class OpenBins:
    """Open bins by remaining capacity: ranges of bin numbers at the leaves of a segment tree."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.any = bytearray(2 * self.size)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]

    def put(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.ranges[capacity].append((first, count))
            node = capacity + self.size
            while node and not self.any[node]:
                self.any[node] = 1
                node >>= 1

    def tightest(self, length: int) -> int | None:
        """Smallest capacity of an open bin that is at least ``length``."""
        node = length + self.size
        while not self.any[node]:
            while node & 1:  # a right child: go up until there is something to the right
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.size

    def take(self, capacity: int) -> tuple[int, int]:
        found = self.ranges[capacity].pop()
        node = capacity + self.size
        if not self.ranges[capacity]:
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return found


@dataclass(frozen=True)
class Run:
    """``items`` pieces of a length, from number ``item`` on, ``per_bin`` to each bin from ``bin`` on."""

    length: int
    item: int
    items: int
    per_bin: int
    bin: int
    offset: int


def best_fit(histogram: dict[int, int], limit: int = LIMIT) -> list[Run]:
    """Best fit decreasing of ``length -> pieces`` into bins of ``limit``."""
    bins, made, runs = OpenBins(limit), 0, []
    for length in sorted(histogram, reverse=True):
        item, left = 0, histogram[length]
        while left:
            capacity = bins.tightest(length)
            if capacity is None:
                capacity, count = limit, -(-left // (limit // length))
                first, made = made, made + count
            else:
                first, count = bins.take(capacity)
            per_bin = capacity // length
            full = min(count, left // per_bin)
            if full:
                runs.append(Run(length, item, full * per_bin, per_bin, first, limit - capacity))
                bins.put(capacity - per_bin * length, first, full)
                first, count = first + full, count - full
                item, left = item + full * per_bin, left - full * per_bin
            if left and count:
                runs.append(Run(length, item, left, left, first, limit - capacity))
                bins.put(capacity - left * length, first, 1)
                first, count, left = first + 1, count - 1, 0
            bins.put(capacity, first, count)
    return runs


def pieces(df: DataFrame, key: str, text: str, content: str, limit: int, end: int) -> DataFrame:
    """``key, piece, start, length, ids_crc32, part, nth`` of each document's ids and the end id.

    ``nth`` numbers the pieces of a length within the task ``part`` that made them.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(content).encode, TaskContext.get().partitionId()
        met, last = np.zeros(limit + 1, np.int64), end.to_bytes(4, "little")
        for block in blocks(batches, "text", BLOCK_BYTES):
            owner, piece, start, length, crc, nth = [], [], [], [], [], []
            for i, ids in enumerate(encode(block.column("text"))):
                ids += last
                for p, at in enumerate(range(0, len(ids), 4 * limit)):
                    cut = ids[at : at + 4 * limit]
                    size = len(cut) // 4
                    owner.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(size)
                    crc.append(zlib.crc32(cut))
                    nth.append(met[size])
                    met[size] += 1
            taken = block.select(["key"]).take(pa.array(owner, pa.int64()))
            for name, values, of in (
                ("piece", piece, pa.int32()),
                ("start", start, pa.int64()),
                ("length", length, pa.int64()),
                ("ids_crc32", crc, pa.int64()),
                ("part", [part] * len(owner), pa.int32()),
                ("nth", nth, pa.int64()),
            ):
                taken = taken.append_column(name, pa.array(values, of))
            yield from taken.to_batches()

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run,
        f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint",
    )


def place(numbered: DataFrame, runs: list[Run], limit: int) -> DataFrame:
    """``sequence_id, offset`` behind the columns of ``numbered``, by ``length`` and ``number``."""
    span = 1 << 48
    table = np.array(
        sorted((r.length * span + r.item, r.item, r.per_bin, r.bin, r.offset) for r in runs), np.int64
    ).reshape(-1, 5)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(table[:, 0], length * span + number, "right") - 1
            _, item, per_bin, first, offset = table[at].T
            ahead = number - item
            out = batch.append_column("sequence_id", pa.array(first + ahead // per_bin))
            yield out.append_column("offset", pa.array(offset + ahead % per_bin * length))

    schema = T.StructType(
        [
            *numbered.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return numbered.mapInArrow(run, schema)


def pack(
    df: DataFrame, key: str, text: str, content: str, limit: int = LIMIT, end: int = 0
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset``: where each piece is packed.

    A document is its ids and the ``end`` id, so a null or empty text is one piece of length 1. Only
    documents longer than ``limit`` are cut, into pieces of ``limit`` and one rest. Repeated rows
    and rows with null or repeated keys are documents of their own. Offsets of a sequence leave no
    gap. An empty table gives an empty result.
    """
    checkpoints(df.sparkSession)
    made = stored(pieces(df, key, text, content, limit, end), "pieces")
    counts = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "bases")
    histogram = bases.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most limit rows
    runs = best_fit({r["length"]: r["n"] for r in histogram}, limit)
    # bases grow with the tasks, so they are not left to be broadcast
    numbered = made.join(bases.hint("merge"), ["part", "length"]).select(
        F.col("key").alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("base") + F.col("nth")).alias("number"),
    )
    return place(numbered, runs, limit).drop("number")
