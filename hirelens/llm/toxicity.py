"""Toxicity by logistic regression, trained with FTRL-proximal on hashed n-grams and skip-grams.

A text is the set of its hashed features: single words, pairs of neighbours, and pairs with one word
between them. Training keeps a rate of its own for each coordinate and drives coordinates without
clear evidence to exactly zero, so what is broadcast for scoring is a short list of weights.

The model is fitted on a bounded sample: at most ``max_rows`` labelled rows, the ones with the
smallest hash of their key. Texts become features where they are read; only the features of the
sample meet in the one task that trains.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import blocks

BITS = 20  # hashed features: 2^20 coordinates, 4 MB of dense weights
MAX_ROWS = 20_000  # labelled rows the model is fitted on, at most
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
TO_SPACE = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass(frozen=True)
class Weights:
    """The coordinates that are not zero; ``bias`` belongs to every text."""

    bias: float
    index: np.ndarray
    value: np.ndarray

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.index] = self.value
        return table


def features(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    """Hashed features of a whole text, repeats included; a text without a word has none."""
    if not text:
        return np.empty(0, np.int64)
    tokens = text.lower().encode().translate(TO_SPACE).split()
    for w in set(tokens).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    one = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    with np.errstate(over="ignore"):
        kinds = [one * ODD[0]]
        for gap in (1, 2):
            if len(one) > gap:
                pair = one[:-gap] * ODD[gap] + (one[gap:] ^ (one[gap:] >> np.uint64(31)))
                kinds.append((pair ^ (pair >> np.uint64(29))) * ODD[0])
    return (np.concatenate(kinds) >> np.uint64(64 - BITS)).astype(np.int64)


def ftrl(
    rows: list[tuple[np.ndarray, int]],
    epochs: int,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
) -> Weights:
    """FTRL-proximal over ``(distinct features, label)``, in the order given."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z0 = n0 = bias = 0.0
    for _ in range(epochs):
        for index, label in rows:
            zi, ni = z[index], n[index]
            root = np.sqrt(ni)
            w = np.where(
                np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + root) / alpha + l2)
            )
            bias = -z0 / ((beta + n0**0.5) / alpha)  # no penalty on what every text has
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - label
            z[index] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * w
            n[index] = ni + g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0**0.5) / alpha * bias
            n0 += g * g
    index = np.flatnonzero(np.abs(z) > l1)
    value = (np.sign(z[index]) * l1 - z[index]) / ((beta + np.sqrt(n[index])) / alpha + l2)
    return Weights(-z0 / ((beta + n0**0.5) / alpha), index, value.astype(np.float32))


def held_out(key: Column) -> Column:
    """Whether labels of this key are never learned from: crc32 of the key as text, modulo 5, is 0."""
    return F.crc32(key.cast("string")) % 5 == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    label: str,
    max_rows: int = MAX_ROWS,
    epochs: int = 6,
    alpha: float = 3.0,
    beta: float = 1.0,
    l1: float = 6.0,
    l2: float = 1.0,
) -> Weights:
    """Weights from the labelled texts that are not held out.

    Null keys and null labels are left out; a key labelled twice counts as 1 if any label is 1; a
    key with several texts gives one row each. Without any labelled row all scores are 0.5.
    """
    known_labels = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    chosen = (
        known_labels.groupBy(F.col(key).alias("_key"))
        .agg(F.max(F.col(label).cast("int")).alias("_label"))
        .filter(~held_out(F.col("_key")))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(max_rows)
    )
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), "_key"  # at most max_rows rows of a key and a label
    )

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for block in blocks(batches, "text"):
            if len(known) > 200_000:
                known.clear()
            sets = [
                np.unique(features(t, known)).astype("<i4").tobytes()
                for t in block.column("text").to_pylist()
            ]
            kept = block.select(["place", "label"]).append_column("x", pa.array(sets, pa.binary()))
            yield from kept.to_batches()

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for x, y in zip(batch.column("x").to_pylist(), batch.column("label").to_pylist()):
                rows.append((np.frombuffer(x, "<i4"), y))
        weights = ftrl(rows, epochs, alpha, beta, l1, l2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(weights.index, -1), pa.int64()),
                pa.array(np.append(weights.value.astype(float), weights.bias), pa.float64()),
            ],
            names=["i", "w"],
        )

    staged = sample.select(
        F.xxhash64("_key", "_text").alias("place"),
        F.col("_label").alias("label"),
        F.col("_text").alias("text"),
    ).mapInArrow(hashed, "place bigint, label int, x binary")
    trained = staged.repartition(1).sortWithinPartitions("place").mapInArrow(train, "i bigint, w double")
    found = {r["i"]: r["w"] for r in trained.collect()}  # the weights, at most 2^BITS + 1
    bias = found.pop(-1, 0.0)
    order = sorted(found)
    return Weights(bias, np.array(order, np.int64), np.array([found[i] for i in order], np.float32))


def score(df: DataFrame, text: str, weights: Weights, into: str = "score") -> DataFrame:
    """All columns of ``df`` with the score (0 to 1) behind them; null and empty texts score the bias."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = weights.dense(), {}
        for block in blocks(batches, text):
            if len(known) > 200_000:
                known.clear()
            sums = []
            for value in block.column(text).to_pylist():
                x = features(value, known)
                x = np.unique(x[table[x] != 0])
                sums.append(weights.bias + float(table[x].astype(float).sum()))
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums), -700, 700)))
            yield from block.append_column(into, pa.array(scores, pa.float64())).to_batches()

    schema = T.StructType([*df.schema.fields, T.StructField(into, T.DoubleType())])
    return df.mapInArrow(run, schema)
