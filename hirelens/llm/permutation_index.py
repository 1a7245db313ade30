"""Approximate nearest neighbours by a permutation index.

Vectors are described by which pivots are nearest to them, in order. Each pivot has an inverted file
of the vectors that have it among their nearest, with its place there. A query reads the files of its
own nearest pivots, which adds up to the footrule distance of the two prefixes; vectors within a
footrule radius are candidates, and their exact inner products decide.

The nearest by inner product are found as the nearest by angle after one coordinate is added to each
vector that brings it to the largest norm, and zero to each query. Vectors are dealt to blocks by
their hash; each block has an index of its own in memory, and all queries pass every block in a
stream. The radius has no cap behind it: all vectors within it are compared, and where a block has
fewer than ``k`` within it, the whole block is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import checkpoints, stored
from hirelens.operators.skew import top_k

PIVOTS = 256  # the bounded sample that the index is fitted on
PREFIX = 64  # nearest pivots that describe a vector
RADIUS = 0.8  # share of the largest possible footrule distance
BLOCK = 4096  # vectors of a block, about


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components present and finite."""
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


class Index:
    """Inverted files of one block, each pivot's as an array over the block's vectors.

    The array holds how far before the end of the prefix the pivot stands, and zero where it is not
    in the prefix, so the posts that two prefixes share add up by a minimum.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, norm: float):
        self.ids, self.vectors, self.pivots = ids, vectors, pivots
        self.prefix = min(PREFIX, len(pivots))
        missing = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(axis=1), 0))
        near = self.nearest(np.column_stack([vectors, missing]))
        self.files = np.zeros((len(pivots), len(ids)), np.int16)
        weight = np.broadcast_to(np.arange(self.prefix, 0, -1, dtype=np.int16), near.shape)
        self.files[near, np.arange(len(ids))[:, None]] = weight

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """The prefix of each point: its nearest pivots, nearest first."""
        return np.argsort(-(points @ self.pivots.T), axis=1, kind="stable")[:, : self.prefix]

    def search(self, query: int, vector: np.ndarray, prefix: np.ndarray, k: int) -> tuple:
        shared = np.zeros(len(self.ids), np.int32)
        for place, pivot in enumerate(prefix):
            shared += np.minimum(self.files[pivot], np.int16(self.prefix - place))
        footrule = self.prefix * (self.prefix + 1) - 2 * shared
        others = self.ids != query
        near = np.flatnonzero((footrule <= RADIUS * self.prefix * (self.prefix + 1)) & others)
        if len(near) < k:
            near = np.flatnonzero(others)
        scores = (self.vectors[near] * vector).sum(axis=1)
        best = np.lexsort((self.ids[near], -scores))[:k]
        return self.ids[near[best]], scores[best]


def padded(values: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for row, value in zip(out, values):
        row[: len(value)] = value
    return out


def nearest_neighbours(
    df: DataFrame, key: str, vector: str, is_query: Column, k: int = 20, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, <key>, score``: the ``k`` nearest found for each row that is a query.

    Vectors that are not usable take no part, nor do rows without a key. Rows that share a key are
    one vector, the smallest of them. A shorter vector is filled up with zeros. Ties go to the
    smaller key. A query with fewer than ``k`` others gets them all; an empty table gives no rows.
    """
    spark = df.sparkSession
    checkpoints(spark)
    rows = stored(
        df.filter(F.col(key).isNotNull() & usable(F.col(vector)))
        .withColumn("_query", is_query)
        .groupBy(F.col(key).cast("bigint").alias("id"))
        .agg(
            F.min(F.col(vector).cast("array<double>")).alias("vector"), F.max("_query").alias("query")
        ),
        "vectors",
    )
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.max(square).alias("most")
    ).first()
    n, width, norm = seen["n"], seen["width"] or 1, (seen["most"] or 0.0) ** 0.5
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("vector").collect()
    raw = padded([r["vector"] for r in chosen], width)
    missing = np.sqrt(np.maximum(norm * norm - (raw * raw).sum(axis=1), 0))
    pivots = np.column_stack([raw, missing])
    many = max(1, -(-n // block))

    dealt = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(many)).cast("int").alias("block"),
        F.lit(0).alias("kind"),
        "id",
        "vector",
    ).unionByName(
        rows.filter("query").select(
            F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("block"),
            F.lit(1).alias("kind"),
            "id",
            "vector",
        )
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block, its vectors before the queries."""
        current, ids, vectors, index = None, [], [], None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("block", "kind")]
            marks = np.array(columns, np.int64).T
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for low, high in zip(np.append(0, cuts), np.append(cuts, len(marks))):
                number, kind = marks[low]
                part = batch.slice(low, high - low)
                part_ids = part.column("id").to_numpy()
                points = padded(part.column("vector").to_pylist(), width)
                if number != current:
                    current, ids, vectors, index = number, [], [], None
                if kind == 0:
                    ids.append(part_ids)
                    vectors.append(points)
                    continue
                if not ids:
                    continue
                index = index or Index(np.concatenate(ids), np.concatenate(vectors), pivots, norm)
                prefixes = index.nearest(np.column_stack([points, np.zeros(len(points))]))
                found = [
                    index.search(q, p, prefix, k) for q, p, prefix in zip(part_ids, points, prefixes)
                ]
                owner = np.repeat(part_ids, [len(f[0]) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(owner),
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(np.concatenate([f[1] for f in found])),
                    ],
                    names=["query_id", "id", "score"],
                )

    ordered = dealt.repartition("block").sortWithinPartitions("block", "kind")
    found = ordered.mapInArrow(run, "query_id bigint, id bigint, score double")
    best = top_k(found, ["query_id"], [F.desc("score"), F.col("id")], k)
    return best.select("query_id", "rank", F.col("id").alias(key), "score")
