"""Similar texts without a missed pair: a prefix join of their sets of word shingles.

Shingles are put in one order, rare ones first. If two sets have a Jaccard similarity of ``t``, the
first ``|x| - ceil(t |x|) + 1`` shingles of each have one in common, at places that leave enough
common ones behind them. So only these prefixes are posted, a posting that no other group
of sets shares is dropped, and sets that share one are candidates.

The order comes from how often shingles occur: a table of ``2^BITS`` counters, filled from all texts,
which is small enough to be given to every task. Any order gives the same pairs; counters decide
only how long the lists of postings get. Lists that the counters show to be long are dealt to
blocks before they are shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens.session import give_back

BITS = 22  # 2^22 counters: 4 MB as levels
FEW_ROWS = 200  # rows of a batch that are Python objects at once
FEW_KEYS = 10_000  # asked keys that are broadcast, at most
KEY_BITS = 20  # cells of the bitmap of asked keys
SHARD = 1 << 16  # counters that travel as one row
EXTRA = 0.03  # share of a set's shingles that count as early beyond the fewest that must
BLOCK = 50_000  # postings of a list that meet in one group, about
WORDS = r"[^\W_]+"  # runs of letters and digits
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class Shingler:
    """Sets of shingle hashes of texts; words are what the pattern finds in the lower-cased text."""

    def __init__(self, size: int, words: str = WORDS):
        self.size, self.words = size, re.compile(words)

    def __call__(self, text: str | None) -> np.ndarray:
        """Distinct hashes of the word shingles of a text, sorted. A text with fewer words has all of
        them as its only one, a text without words has none."""
        words = self.words.findall(text.lower()) if text else []
        if not words:
            return np.empty(0, np.uint64)
        one = hash_array(np.array(words, object), categorize=False)
        size = min(self.size, len(words))
        mixed = np.full(len(one) - size + 1, size, np.uint64)
        for i in range(size):
            mixed = (mixed ^ (mixed >> np.uint64(29)) ^ one[i : i + len(mixed)]) * ODD
        return np.unique((mixed ^ (mixed >> np.uint64(32))) * MIX)


def texts(batches: Iterable[pa.RecordBatch], once: bool = False) -> Iterator[tuple]:
    """``(key, text)`` rows of batches; with ``once``, of equal texts of a task the first only.

    A few rows of a batch are Python objects at a time; a task gives its memory back at its end.
    """
    seen: set[bytes] = set()
    for batch in batches:
        for start in range(0, batch.num_rows, FEW_ROWS):
            part = batch.slice(start, FEW_ROWS)
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if once and text is not None:
                    digest = hashlib.blake2b(text.encode(), digest_size=16).digest()
                    if digest in seen:
                        continue
                    seen.add(digest)
                yield key, text
    give_back()


class Counters:
    """How often hashes occur, by the counter they fall on."""

    def __init__(self):
        self.counts = np.zeros(1 << BITS, np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        np.add.at(self.counts, counter(hashes), 1)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        for shard in range(len(self.counts) // SHARD):
            part = self.counts[shard * SHARD : (shard + 1) * SHARD]
            if part.any():
                yield shard, zlib.compress(part.tobytes(), 1)


def counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def levels(shards: DataFrame) -> np.ndarray:
    """One byte per counter, the bit length of its sum over all rows of ``shard, counts``.

    Sums are made shard by shard in two steps, so a task holds a counter table whatever the number
    of rows; what comes to the driver is one row per shard.
    """

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(blob), np.uint32).astype(np.int64)
                totals[shard] = totals[shard] + part if shard in totals else part
        for shard, total in totals.items():
            total = np.minimum(total, 2**32 - 1).astype(np.uint32)
            blob = zlib.compress(total.tobytes(), 1)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "counts": [blob]})

    schema = "shard int, counts binary"
    salted = shards.select("shard", "counts", (F.xxhash64("counts") % 16).alias("salt"))
    first = salted.repartition("shard", "salt").select("shard", "counts").mapInArrow(merge, schema)
    table = np.zeros(1 << BITS, np.uint8)
    for shard, blob in first.repartition("shard").mapInArrow(merge, schema).collect():
        counts = np.frombuffer(zlib.decompress(blob), np.uint32).astype(float)
        table[shard * SHARD : (shard + 1) * SHARD] = np.ceil(np.log2(counts + 1)).astype(np.uint8)
    return table


def prefix_length(size: int, similarity: float) -> int:
    """Shingles of a set of which one must be shared with any set that similar."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def prefixes(
    df: DataFrame, shingle: int, similarity: float, table: np.ndarray, words: str = WORDS
) -> DataFrame:
    """``key, size, tokens, blocks``: the prefix of each text of ``df`` (``key, text``), a row per text.

    A token whose list is long by its counter is dealt to blocks by key, with a block of at least 0; a
    text without such a token has null ``blocks``. Of equal texts of a task one is taken.
    """
    kind = df.schema["key"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    long_level = BLOCK.bit_length()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held, total = Shingler(shingle, words), [], 0
        for key, text in texts(batches, once=True):
            hashes = shingles(text)
            if not len(hashes):
                continue
            level = table[counter(hashes)]
            first = np.lexsort((hashes, level))[: prefix_length(len(hashes), similarity)]
            long = level[first].astype(np.int64) - long_level
            block = None
            if (long > 0).any():
                own = zlib.crc32(str(key).encode())
                block = np.where(long > 0, own % (1 << np.clip(long, 0, 30)), -1).astype(np.int32)
            held.append((key, len(hashes), hashes[first].view(np.int64), block))
            total += len(first)
            if total > 100_000:
                yield rows_of(held, arrow)
                held, total = [], 0
        if held:
            yield rows_of(held, arrow)

    schema = f"key {kind}, size int, tokens array<bigint>, blocks array<int>"
    return df.select("key", "text").mapInArrow(run, schema)


def rows_of(held: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (kind, pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    columns = [pa.array(list(values), t) for values, t in zip(zip(*held), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "size", "tokens", "blocks"])


def postings(placed: DataFrame) -> DataFrame:
    """``token, block, key, hub, size, place``: the prefixes of ``placed`` (``key, hub, size, tokens,
    blocks``) token by token, without those whose list has one hub only: they make no pair of hubs, nor of
    members of two. Lists dealt to blocks stay whole."""
    block = F.coalesce(F.get("blocks", F.col("place")), F.lit(-1))
    dealt = placed.select("key", "hub", "size", "blocks", F.posexplode("tokens").alias("place", "token"))
    dealt = dealt.select("token", block.alias("block"), "key", "hub", "size", "place")
    listed = Window.partitionBy("token", "block")
    ends = dealt.withColumns({"_least": F.min("hub").over(listed), "_most": F.max("hub").over(listed)})
    return ends.filter("_least <> _most or block >= 0").drop("_least", "_most")


def room(similarity: float) -> str:
    """SQL condition on two lists of places of one shingle, ``a`` and ``b``: sizes (``least`` to ``most``)
    and places (``place`` and ``rest`` behind it, the largest of each) leave room for the similarity, and
    one that may be the smaller has the shingle ``early``."""
    t = similarity
    return (
        f"a.most >= {t}D * b.least - 1e-9D and b.most >= {t}D * a.least - 1e-9D"
        " and (a.early and a.least <= b.most or b.early and b.least <= a.most)"
        " and least(a.place, b.place) + least(a.rest, b.rest)"
        f" >= {t / (1 + t)!r}D * (a.least + b.least) - 1e-6D"
    )


def late(size: str, similarity: float) -> str:
    """SQL for the shingles of the smaller of two sets that stand behind its early ones."""
    t = similarity
    return f"(ceil({2 * t / (1 + t)!r}D * {size} - 1e-9D) - 1 - floor({EXTRA}D * {size}))"


def enough(similarity: float) -> str:
    """SQL condition on two prefixes that share ``n`` shingles: of sets with ``a0`` and ``b0`` shingles.

    Counted are shingles of the prefix of the larger set that are early ones of the smaller. Whatever
    the sets have in common beyond the one of these that ends first lies in the rest of that set. So
    they share at most ``n`` and the longer rest. Groups of sets of several sizes (to ``a1``, ``b1``)
    need only share one.
    """
    t = similarity
    rest = f"greatest(ceil({t}D * greatest(a0, b0) - 1e-9D) - 1, {late('least(a0, b0)', t)})"
    return f"a0 < a1 or b0 < b1 or n >= {t / (1 + t)!r}D * (a0 + b0) - {rest} - 1e-6D"


def prefix_pairs(posted: DataFrame, name: str, similarity: float) -> DataFrame:
    """``src, dst`` (``src > dst``): values of ``name`` in ``posted`` that share enough postings.

    With the key as ``name`` these are sets that may be alike; with a group of sets, groups of which
    two members may be. A larger set must have a shingle in its prefix, of the smaller the early part
    of the prefix will do, as it leaves out the more frequent ones; ``EXTRA`` of them more are
    counted, so that alike sets share many and others can be told by their number.
    """
    ends = posted.groupBy("token", F.col(name).alias("name")).agg(
        F.min("size").alias("least"),
        F.max("size").alias("most"),
        F.max("place").alias("place"),
        F.max(F.col("size") - F.col("place")).alias("rest"),
        F.max(F.expr(f"size - place > {late('size', similarity)}")).alias("early"),
    )
    fields = ("name", "least", "most", "place", "rest", "early")
    a, b = (ends.select("token", F.struct(*fields).alias(n)) for n in "ab")
    met = a.join(b.hint("merge"), "token").filter("a.name > b.name").filter(room(similarity))
    counted = met.groupBy(F.col("a.name").alias("src"), F.col("b.name").alias("dst")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("a.least").alias("a0"),
        F.max("a.most").alias("a1"),
        F.min("b.least").alias("b0"),
        F.max("b.most").alias("b1"),
    )
    return counted.filter(enough(similarity)).select("src", "dst")


def shingle_sets(df: DataFrame, keys: DataFrame, shingle: int, words: str = WORDS) -> DataFrame:
    """``key, shingles`` of those texts of ``df`` (``key, text``) whose key is in ``keys`` (distinct).

    Texts stay where they are read. Up to ``FEW_KEYS`` keys are given to every task; of more, a bitmap
    of a fixed size, and the sets that it lets through then meet the keys themselves.
    """
    kind = df.schema["key"].dataType.simpleString()
    cell = F.shiftrightunsigned(F.xxhash64("key"), 64 - KEY_BITS)
    asked = np.zeros(1 << KEY_BITS, bool)
    counted = keys.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    cells = counted.toArrow()  # at most 2^KEY_BITS rows
    asked[cells.column("cell").to_numpy()] = True
    few = int(cells.column("n").to_numpy().sum()) <= FEW_KEYS
    if few:
        df = df.join(F.broadcast(keys), "key", "left_semi")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(shingle, words)
        for batch in batches:
            some = batch.filter(pa.array(asked[batch.column(2).to_numpy()]))
            for start in range(0, some.num_rows, FEW_ROWS):
                part = some.slice(start, FEW_ROWS)
                sets = [shingles(t).view(np.int64) for t in part.column(1).to_pylist()]
                lists = pa.array(sets, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["key", "shingles"])
        give_back()

    found = df.select("key", "text", cell).mapInArrow(
        run, f"key {kind}, shingles array<bigint>"
    )
    return found if few else found.join(keys.hint("merge"), "key", "left_semi")


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (``src, dst`` and more) with ``far``: one minus the Jaccard similarity of the sets, one for
    two empty sets.

    Keys of ``sets`` are unique, so a frequent end of pairs is left to the engine's skew split. Neither
    side is broadcast: files of pairs and the texts that sets are made of say little about their size.
    """
    a = sets.select(F.col("key").alias("src"), F.col("shingles").alias("_a"))
    b = sets.select(F.col("key").alias("dst"), F.col("shingles").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    all_of = F.size("_a") + F.size("_b") - both
    far = F.when(all_of > 0, 1 - both / all_of).otherwise(1.0)
    met = pairs.join(a.hint("merge"), "src").join(b.hint("merge"), "dst")
    return met.select(*pairs.columns, far.alias("far"))
