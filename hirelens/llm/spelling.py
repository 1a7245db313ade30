"""Spelling variants of words, by k-d trees over letter counts.

A word becomes the vector of how often it has each letter. One replaced letter takes one from a
coordinate and adds one to another, one inserted letter adds one to a coordinate: words one edit
apart have vectors within Manhattan distance two. Words of each length are laid out by a k-d tree;
its upper part, fitted on a bounded sample, deals them to cells, and a tree built in each cell goes
on to a few words. A word asks the cells of its own length and of the next length whose boxes lie
near enough, the tree there prunes further, and what is left is compared letter by letter.

The sample decides only how evenly cells are filled: every word is in exactly one cell and asks
every cell that may hold a near word, so no near pair is missed and each is found once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import blocks, checkpoints, give_back, stored

LETTERS = b"abcdefghijklmnopqrstuvwxyz" + bytes(range(0xC0, 0x100))  # in Latin-1
TO_LETTERS = bytes(c if c in LETTERS else 32 for c in bytes(range(256)).lower())
HELD = 500_000  # distinct words that a task counts before it hands them on
DIMENSIONS = 32  # a to z, and the other letters dealt to six coordinates
SAMPLE = 200_000  # words that the upper trees are fitted on, at most
CELL = 4_096  # words of a cell; fuller ones are split into blocks
CELLS = 1 << 16  # cells of all upper trees together, at most (and one more per length)
FEW = 32  # words of a leaf in the tree of a cell
DIMENSION = np.array([c - 97 if 97 <= c <= 122 else 26 + c % 6 for c in range(256)])
MEMBER, OWN, OTHER, SHORTER = range(4)  # what a row is to its cell


def word_counts(
    df: DataFrame,
    key: str,
    text: str,
    min_length: int = 6,
    min_count: int = 5,
    slip: int | None = None,
) -> DataFrame:
    """``word, n``: runs of Latin letters of all texts with A-Z lower-cased, and how often each occurs.

    Where ``slip`` divides the crc32 of ``<key>:<run>``, the run loses the letter at that crc32
    modulo its length, as a typist would drop it; ``None`` leaves runs as they are. A null key
    counts as empty text, a null text has no run. Tasks count what they read before it is shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for block in blocks(batches, "text"):
            keys, texts = (block.column(c).to_pylist() for c in ("key", "text"))
            for name, value in zip(keys, texts):
                # one byte per code point; all that is not a letter of these becomes a space
                plain = (value or "").encode("latin-1", "replace").translate(TO_LETTERS)
                runs = [r for r in plain.split() if len(r) >= min_length]
                if slip and runs:
                    start = zlib.crc32(f"{name}:".encode())
                    as_text = (r if r.isascii() else r.decode("latin-1").encode() for r in runs)
                    hashes = np.fromiter(map(zlib.crc32, as_text, repeat(start)), np.uint32, len(runs))
                    for i in np.flatnonzero(hashes % slip == 0).tolist():
                        place = int(hashes[i]) % len(runs[i])
                        runs[i] = runs[i][:place] + runs[i][place + 1 :]
                seen.update(runs)
            if len(seen) > HELD:
                yield counted(seen, min_length)
                seen.clear()
        yield counted(seen, min_length)

    rows = df.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.col(text).cast("string").alias("text"),
    )
    words = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter(F.col("n") >= min_count)


def counted(seen: Counter[bytes], least: int) -> pa.RecordBatch:
    words = [w for w in seen if len(w) >= least]
    texts = pa.array([w.decode("latin-1") for w in words], pa.string())
    counts = pa.array([seen[w] for w in words], pa.int64())
    return pa.RecordBatch.from_arrays([texts, counts], names=["word", "n"])


class KdTree:
    """Boxes of count vectors, split at medians until they hold at most ``size`` of them."""

    def __init__(self, vectors: np.ndarray, size: int):
        self.dim, self.cut, self.low, self.high, self.leaf = [], [], [], [], []
        self.leaves: list[np.ndarray] = []
        open_nodes = [(self._node(), np.arange(len(vectors)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            dim, cut = best_cut(vectors[rows]) if len(rows) > size else (-1, 0)
            if dim < 0:
                self.leaf[node] = len(self.leaves)
                self.leaves.append(rows)
                continue
            below = vectors[rows, dim] <= cut
            self.dim[node], self.cut[node] = dim, cut
            self.low[node], self.high[node] = self._node(), self._node()
            open_nodes += [(self.low[node], rows[below]), (self.high[node], rows[~below])]

    def _node(self) -> int:
        for column in (self.dim, self.cut, self.low, self.high, self.leaf):
            column.append(-1)
        return len(self.dim) - 1

    def reach(self, asked: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the rows of ``asked`` that can have a vector there whose coordinates lie at
        most ``up`` above and at most ``down`` below, each summed over all coordinates."""
        none = np.zeros(len(asked), np.int64)
        stack = [(0, np.arange(len(asked)), none, none, {}, {})]
        while stack:
            node, rows, above, under, floor, ceiling = stack.pop()
            if self.leaf[node] >= 0:
                yield self.leaf[node], rows
                continue
            dim, cut = self.dim[node], self.cut[node]
            c = asked[rows, dim].astype(np.int64)
            more = under + np.maximum(c - cut, 0)
            if dim in ceiling:
                more -= np.maximum(c - ceiling[dim], 0)
            near = more <= down
            if near.any():
                low = (rows[near], above[near], more[near], floor, {**ceiling, dim: cut})
                stack.append((self.low[node], *low))
            more = above + np.maximum(cut + 1 - c, 0)
            if dim in floor:
                more -= np.maximum(floor[dim] - c, 0)
            near = more <= up
            if near.any():
                high = (rows[near], more[near], under[near], {**floor, dim: cut + 1}, ceiling)
                stack.append((self.high[node], *high))


def best_cut(vectors: np.ndarray) -> tuple[int, int]:
    """The coordinate and the value (last of the lower side) that part the vectors most evenly;
    coordinate -1 if all are equal."""
    half = len(vectors) // 2
    middle = np.partition(vectors, half, axis=0)[half].astype(np.int64)
    best = (0, -1, 0)
    for cuts in (middle - 1, middle):
        lower = (vectors <= cuts).sum(axis=0)
        even = np.minimum(lower, len(vectors) - lower)
        dim = int(even.argmax())
        best = max(best, (int(even[dim]), dim, int(cuts[dim])))
    if best[0]:
        return best[1:]
    apart = np.flatnonzero(vectors.min(axis=0) < vectors.max(axis=0))  # all but few are equal
    return (int(apart[0]), int(vectors[:, apart[0]].min())) if len(apart) else (-1, 0)


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(matrix: np.ndarray) -> np.ndarray:
    """Count vectors of the rows of a letter matrix."""
    places = DIMENSION[matrix] + DIMENSIONS * np.arange(len(matrix))[:, None]
    counts = np.bincount(places.ravel(), minlength=len(matrix) * DIMENSIONS)
    return counts.reshape(-1, DIMENSIONS).astype(np.int32 if matrix.shape[1] > 30_000 else np.int16)


def unary(counts: np.ndarray) -> np.ndarray:
    """Count vectors as 64 bits, two per coordinate: one or more, two or more. The number of bits in
    which two differ is at most the Manhattan distance of the vectors."""
    bits = np.stack([counts >= 1, counts >= 2], axis=2).reshape(len(counts), 2 * DIMENSIONS)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``b`` (same length or one longer) is one edit away from that of ``a``."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= a.shape[1]


def near_rows(
    tree: KdTree, members: np.ndarray, codes: np.ndarray, asking: np.ndarray, up: int, down: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, of ``asking`` and of ``members``, that are one edit apart.

    The boxes leave a few members per question, the distance of the counts fewer, and the order of
    the letters decides.
    """
    counts = letter_counts(asking)
    asked = unary(counts)
    for leaf, rows in tree.reach(counts, up, down):
        held = tree.leaves[leaf]
        step = max(1, 4_000_000 // len(held))
        for start in range(0, len(rows), step):
            some = rows[start : start + step]
            apart = np.bitwise_count(codes[held][None] ^ asked[some][:, None])
            i, j = np.nonzero(apart <= up + down)
            for k in range(0, len(i), 1 << 16):  # letters of a bounded number of pairs at once
                q, m = some[i[k : k + (1 << 16)]], held[j[k : k + (1 << 16)]]
                near = one_edit(asking[q], members[m])
                if near.any():
                    yield q[near], m[near]


class Layout:
    """Which cells the words of each length are in, and how many blocks a cell has."""

    def __init__(self, words: DataFrame, total: int, cell: int, sample: int):
        order = [F.xxhash64("word"), F.col("word")]
        taken = words.select("word").orderBy(*order).limit(sample).toArrow().column("word")
        share = len(taken) / total if total else 1.0
        size = max(1, int(max(cell, total / CELLS) * share))
        self.trees: dict[int, KdTree] = {}
        for length, some in by_length(taken):
            if len(some) > size:
                self.trees[length] = KdTree(letter_counts(letters(some.to_pylist())), size)
                self.trees[length].leaves = [r[:0] for r in self.trees[length].leaves]
        self.blocks: dict[tuple[int, int], int] = {}

    def cells(self, length: int, counts: np.ndarray, up: int, down: int) -> Iterator:
        """``(cell, rows)`` of a length for rows that may have a near word there."""
        if length in self.trees:
            yield from self.trees[length].reach(counts, up, down)
        else:
            yield 0, np.arange(len(counts))


def by_length(words: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Words of each length."""
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        yield int(length), words.take(pa.array(np.flatnonzero(lengths == length)))


def homes(words: DataFrame, layout: Layout) -> DataFrame:
    """``length, cell, n``: how many words each cell has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in by_length(batch.column("word")):
                counts = letter_counts(letters(some.to_pylist()))
                found = [(cell, len(rows)) for cell, rows in layout.cells(length, counts, 0, 0)]
                yield pa.RecordBatch.from_pydict(
                    {"length": [length] * len(found), "cell": [c for c, _ in found], "n": [n for _, n in found]},
                    pa.schema([("length", pa.int32()), ("cell", pa.int32()), ("n", pa.int64())]),
                )

    placed = words.select("word").mapInArrow(run, "length int, cell int, n bigint")
    return placed.groupBy("length", "cell").agg(F.sum("n").alias("n"))


POSTING = "length int, cell int, block int, role int, word string, n bigint"


def postings(words: DataFrame, layout: Layout) -> DataFrame:
    """Each word in its cell, and as a question to each cell that may hold a near word.

    Of two cells of one length only the later word asks, and within a cell the words that follow in
    order: a near pair is met once.
    """
    types = [("length", pa.int32()), ("cell", pa.int32()), ("block", pa.int32()), ("role", pa.int32())]

    def rows_of(some: pa.Table, length: int, cell: int, block, role: int) -> pa.RecordBatch:
        n = some.num_rows
        values = [length, cell, block, role]
        columns = [
            pa.array(v if isinstance(v, np.ndarray) else np.full(n, v), t) for v, (_, t) in zip(values, types)
        ]
        texts = some.combine_chunks()
        columns += [texts.column("word").combine_chunks(), texts.column("n").combine_chunks()]
        names = [name for name, _ in types] + ["word", "n"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = pa.Table.from_batches([batch])
            lengths = pc.utf8_length(batch.column("word")).to_numpy(zero_copy_only=False)
            for length in map(int, np.unique(lengths)):
                some = given.filter(pa.array(lengths == length))
                texts = some.column("word").to_pylist()
                counts = letter_counts(letters(texts))
                home = np.zeros(len(texts), np.int64)
                for cell, rows in layout.cells(length, counts, 0, 0):
                    home[rows] = cell
                    blocks = layout.blocks.get((length, cell), 1)
                    block = np.array([zlib.crc32(texts[r].encode()) % blocks for r in rows], np.int32)
                    yield rows_of(some.take(pa.array(rows)), length, cell, block, MEMBER)
                for cell, rows in layout.cells(length, counts, 1, 1):
                    for role, chosen in ((OWN, home[rows] == cell), (OTHER, home[rows] > cell)):
                        asking = some.take(pa.array(rows[chosen]))
                        for block in range(layout.blocks.get((length, cell), 1) if asking.num_rows else 0):
                            yield rows_of(asking, length, cell, block, role)
                for cell, rows in layout.cells(length + 1, counts, 1, 0):
                    asking = some.take(pa.array(rows))
                    for block in range(layout.blocks.get((length + 1, cell), 1)):
                        yield rows_of(asking, length + 1, cell, block, SHORTER)

    return words.select("word", "n").mapInArrow(run, POSTING)


def near_pairs(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of words one inserted, deleted or replaced letter apart, once.

    ``words`` has distinct words of the letters above, and ``n``. The sample of the upper trees and
    the sizes of cells over ``cell`` words go to the driver; both are bounded.
    """
    spark = words.sparkSession
    total = words.count()
    layout = Layout(words, total, cell, sample)
    full = homes(words, layout).filter(F.col("n") > cell).collect()  # at most one row per cell
    layout.blocks = {(r["length"], r["cell"]): -(-r["n"] // cell) for r in full}

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, tree = None, [], None
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in ("length", "cell", "block", "role")], 1)
            edges = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *edges], [*edges, len(where)]):
                length, _, _, role = map(int, where[start])
                part = batch.slice(start, end - start)
                if here != tuple(where[start, :3]):
                    here, held, tree = tuple(where[start, :3]), [], None
                if role == MEMBER:
                    held.append(part)
                    continue
                if not held:
                    continue  # no word is in this block
                if tree is None:
                    table = pa.Table.from_batches(held)
                    member_words, member_n = (table.column(c).combine_chunks() for c in ("word", "n"))
                    members = letters(member_words.to_pylist())
                    counts = letter_counts(members)
                    codes, tree = unary(counts), KdTree(counts, FEW)
                asking = letters(part.column("word").to_pylist())
                down = 0 if role == SHORTER else 1
                for q, m in near_rows(tree, members, codes, asking, 1, down):
                    q, m = pa.array(q), pa.array(m)
                    a, b = member_words.take(m), part.column("word").take(q)
                    found = pa.Table.from_arrays(
                        [a, member_n.take(m), b, part.column("n").take(q)], names=["a", "a_n", "b", "b_n"]
                    )
                    if role == OWN:  # both ask each other, and each word itself
                        found = found.filter(pc.greater(b, a))
                    yield from found.to_batches()
        give_back()

    order = ["length", "cell", "block"]
    tasks = max(spark.sparkContext.defaultParallelism, total // 16_384)
    met = postings(words, layout).repartition(tasks, *order).sortWithinPartitions(*order, "role")
    return met.mapInArrow(search, "a string, a_n bigint, b string, b_n bigint")


def variants(words: DataFrame, ratio: int = 5, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word, n``).

    A word's form is its most frequent near word (ties: the first in code-point order) if that is at
    least ``ratio`` times as frequent. ``root`` is where the forms lead to, the word itself without
    a form. Each step multiplies the count, so chains are short; they are followed twice as far in
    each round. A word has as many near words as one edit allows, whatever the corpus, so no key of
    these joins is hot. No words give no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words, or chains might not end")
    checkpoints(words.sparkSession)
    words = stored(words.select("word", "n"), "words")
    pairs = near_pairs(words, cell, sample)
    one = F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    two = F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), "other"))
    near = (
        pairs.select(F.inline(F.array(one, two)))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    )
    follows = -F.col("best.rank") >= F.lit(ratio) * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        F.when(follows, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(follows, -F.col("best.rank")).alias("form_n"),
    )
    found = stored(found, "variants")
    return found.join(roots(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(found: DataFrame) -> DataFrame:
    """``word, root`` for words with a form: the last word that forms lead to."""
    steps = found.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ).checkpoint()
        if steps.filter("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.drop("moved")
