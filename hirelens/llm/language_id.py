"""Language identification in two steps: first the family, then the language within it.

A text is what share of its byte n-grams falls on each hashed coordinate. Families, which differ
widely, are told apart by a naive Bayes model of these shares; languages of the family found are
closely related and are told apart by linear support vector machines, one for each two of them,
which vote. Both are linear in the shares, so a whole text is scored in one pass whatever its
length.

Models are fitted on a bounded sample: at most ``max_rows`` texts of each language, those with the
smallest hash. Texts become features where they are read, each machine is trained in a task of its
own, and what comes to the driver are the weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import blocks, checkpoints

BITS = 15  # 2^15 coordinates
ORDERS = (1, 2, 3, 4)  # bytes of an n-gram
MAX_ROWS = 2_000  # texts of a language that the models are fitted on, at most
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
TO_WORDS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
ODD = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))

# Which languages belong to which family; a language that is not listed is its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["an", "ast", "ca", "es", "fr", "gl", "it", "la", "lmo", "oc", "pt", "rm", "ro", "sc"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sh", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd"],
    "uralic": ["et", "fi", "hu", "se"],
    "turkic": ["az", "kk", "ky", "tk", "tr", "tt", "ug", "uz"],
    "indic": ["as", "bn", "gu", "hi", "mr", "ne", "or", "pa", "sa", "sd", "si", "ur"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "semitic": ["am", "ar", "he", "mt"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "sinitic": ["yue", "zh"],
    "malayic": ["id", "jv", "ms", "su"],
}


def family_of(language: str, families: dict[str, list[str]] = FAMILIES) -> str:
    """The family of a language code; region and script behind it (``pt-BR``) do not matter."""
    base = re.split("[-_]", language.lower())[0]
    return next((name for name, codes in families.items() if base in codes), language)


def grams(text: str) -> np.ndarray:
    """Hashed byte n-grams of a whole text, repeats included. Letters are lower-cased; runs of other
    ASCII characters count as one space, also in front and at the end."""
    words = b" ".join([b"", *text.lower().encode().translate(TO_WORDS).split(), b""])
    one = np.frombuffer(words, np.uint8).astype(np.uint32)
    code, found = one, []
    for order in ORDERS:
        if order > 1:
            code = (code[:-1] << np.uint32(8)) | one[order - 1 :]
        mixed = (code ^ (code >> np.uint32(15))) * ODD[order - 1]
        found.append((mixed ^ (mixed >> np.uint32(13))) * ODD[0] >> np.uint32(32 - BITS))
    return np.concatenate(found)


def has_letter(text: str | None) -> bool:
    return bool(text) and LETTER.search(text) is not None


@dataclass(frozen=True)
class Models:
    """What scores a text: log shares of each family, and a machine for each two of its languages."""

    families: list[str]
    logs: np.ndarray  # families x coordinates
    priors: np.ndarray
    languages: dict[str, list[str]]
    machines: dict[tuple[str, str], tuple[np.ndarray, float]]  # weights and bias; above 0: the first

    def predict(self, text: str | None, sharpness: float = 40.0) -> tuple[str, float]:
        """The language of a whole text and how sure that is, 0 to 1.

        The score is the share of the family in the families' likelihood per n-gram (raised to
        ``sharpness``), times the chance of the language's closest vote. Text without a letter, or
        nothing learned: ``und`` and 0.
        """
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        found = grams(text)
        likely = np.array([log[found].mean() for log in self.logs])
        place = int((likely * len(found) + self.priors).argmax())
        sure = 1 / np.exp(np.clip(sharpness * (likely - likely[place]), -700, 0)).sum()
        known = self.languages[self.families[place]]
        votes, margins = dict.fromkeys(known, 0), dict.fromkeys(known, np.inf)
        total = dict.fromkeys(known, 0.0)
        for a, b in combinations(known, 2):
            weights, bias = self.machines[a, b]
            margin = float(weights[found].mean()) + bias
            votes[a if margin > 0 else b] += 1
            for language, own in ((a, margin), (b, -margin)):
                margins[language] = min(margins[language], own)
                total[language] += own
        best = max(known, key=lambda name: (votes[name], total[name]))
        chance = 1 / (1 + np.exp(-2 * np.clip(margins[best], -50, 50)))
        return best, float(min(1.0, sure * chance))


def shares(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of a text and the share of its n-grams that each has."""
    index, counts = np.unique(found, return_counts=True)
    return index.astype(np.int32), (counts / len(found)).astype(np.float32)


def machine(
    rows: list[tuple[np.ndarray, np.ndarray]],
    signs: np.ndarray,
    epochs: int = 30,
    cost: float = 10.0,
    seed: int = 1,
) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge loss), by coordinate descent on the dual.

    Shares are scaled by the root of their mean, so that frequent n-grams do not rule; the scale
    goes into the weights. Each side's cost is shared among its rows. The bias is a weight of a
    coordinate that every row has.
    """
    mean = np.zeros(1 << BITS)
    for index, share in rows:
        mean[index] += share
    scale = 1 / np.sqrt(mean / len(rows) + 1e-5)
    scaled = [(index, share * scale[index]) for index, share in rows]
    size = np.array([float((x * x).sum()) + 1.0 for _, x in scaled])
    sides = np.where(signs > 0, (signs > 0).sum(), (signs < 0).sum())
    soft = sides / (2 * cost * len(rows))  # 1 / (2 C) of each row
    dual, weights, bias = np.zeros(len(rows)), np.zeros(1 << BITS), 0.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            index, x = scaled[i]
            slope = signs[i] * (float(weights[index] @ x) + bias) - 1 + soft[i] * dual[i]
            step = max(dual[i] - slope / (size[i] + soft[i]), 0.0) - dual[i]
            if step:
                dual[i] += step
                weights[index] += step * signs[i] * x
                bias += step * signs[i]
                moved = max(moved, abs(step) * size[i])
        if moved < 1e-3:
            break
    return (weights * scale).astype(np.float32), float(bias)


def held_out(key: Column, modulus: int = 4, fold: int = 2) -> Column:
    """Whether a row is never learned from: the crc32 of its key as text, modulo 4, is 2. False for
    a null key, which has no text; such rows are not learned from either."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus == fold, F.lit(False))


def fit(
    docs: DataFrame,
    key: str,
    text: str,
    lang: str,
    max_rows: int = MAX_ROWS,
    families: dict[str, list[str]] = FAMILIES,
) -> Models:
    """Models of the languages of ``docs``, from rows that are not held out.

    Rows with a null key, text or language, and texts without a letter, teach nothing. Repeated rows
    count as often as they are there. Languages are the values of ``lang``; there must be few enough
    for a machine for each two of a family. No usable row gives models that know no language.
    """
    spark = docs.sparkSession
    checkpoints(spark)
    usable = docs.select(
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(F.col(key), F.col(text)).alias("place"),
        F.col(text).cast("string").alias("text"),
        F.col(key).alias("key"),
    ).filter(
        "lang is not null and text is not null and key is not null"
    ).filter(~held_out(F.col("key")) & F.col("text").rlike(r"\p{L}"))
    counted = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["lang"]: r["n"] for r in counted.collect()}  # one row per language
    if not sizes:
        return Models([], np.empty((0, 1 << BITS)), np.empty(0), {}, {})

    # the rows with the smallest hash: a threshold leaves little more than these, then they are ranked
    def threshold(n: int) -> int:
        share = (2 * max_rows + 50) / n
        return 2**63 - 1 if share >= 1 else int(share * 2**64) - 2**63

    cuts = [(name, threshold(n)) for name, n in sizes.items()]
    cuts = spark.createDataFrame(cuts, "lang string, cut long")
    likely = usable.join(F.broadcast(cuts), "lang").filter(F.col("place") <= F.col("cut"))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows = [shares(grams(t)) for t in block.column("text").to_pylist()]
            out = block.select(["lang", "place"])
            out = out.append_column("i", pa.array([i.tobytes() for i, _ in rows], pa.binary()))
            out = out.append_column("x", pa.array([x.tobytes() for _, x in rows], pa.binary()))
            yield from out.to_batches()

    sparse = likely.select("lang", "place", "text").mapInArrow(
        hashed, "lang string, place bigint, i binary, x binary"
    )
    ranked = sparse.withColumn(
        "rank", F.expr("row_number() over (partition by lang order by place, i, x)")
    )
    sample = ranked.filter(F.col("rank") <= max_rows).drop("rank").checkpoint()

    kin: dict[str, list[str]] = {}
    for name in sorted(sizes):
        kin.setdefault(family_of(name, families), []).append(name)
    order = sorted(kin)
    logs, priors = family_logs(sample, order, kin, sizes)
    machines = pair_machines(sample, kin)
    return Models(order, logs, priors, kin, machines)


def vectors(frame: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    return [
        (np.frombuffer(i, np.int32), np.frombuffer(x, np.float32)) for i, x in zip(frame["i"], frame["x"])
    ]


def family_logs(
    sample: DataFrame, order: list[str], kin: dict[str, list[str]], sizes: dict[str, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Log shares of each family's n-grams (each language counts by its texts), and log priors."""

    def sums(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, tuple[np.ndarray, int]] = {}
        for frame in frames:
            for name, (index, share) in zip(frame["lang"], vectors(frame)):
                total, n = totals.get(name, (np.zeros(1 << BITS), 0))
                total[index] += share
                totals[name] = (total, n + 1)
        if totals:
            yield pd.DataFrame(
                [(name, total.tobytes(), n) for name, (total, n) in totals.items()],
                columns=["lang", "total", "n"],
            )

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(t) for t in frame["total"])
        return pd.DataFrame([(frame["lang"].iloc[0], total.tobytes(), frame["n"].sum())], columns=frame.columns)

    schema = "lang string, total binary, n bigint"
    parts = sample.mapInPandas(sums, schema)  # one vector per language and task
    rows = parts.groupBy("lang").applyInPandas(merged, schema).collect()  # one vector per language
    mean = {r["lang"]: np.frombuffer(r["total"]) / r["n"] for r in rows}
    all_rows = sum(sizes.values())
    logs, priors = [], []
    for name in order:
        weight = np.array([sizes[c] for c in kin[name]], float)
        share = sum(w * mean[c] for w, c in zip(weight / weight.sum(), kin[name]))
        logs.append(np.log(share + 1e-6).astype(np.float32))
        priors.append(np.log(weight.sum() / all_rows))
    return np.array(logs), np.array(priors)


def pair_machines(
    sample: DataFrame, kin: dict[str, list[str]]
) -> dict[tuple[str, str], tuple[np.ndarray, float]]:
    """A machine for each two languages of a family; a task holds the sample of two languages."""
    pairs = [pair for names in kin.values() for pair in combinations(names, 2)]
    if not pairs:
        return {}
    sides = [(n, name, sign) for n, pair in enumerate(pairs) for name, sign in zip(pair, (1, -1))]
    sides = sample.sparkSession.createDataFrame(sides, "pair int, lang string, sign int")

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["sign", "place", "i", "x"])
        weights, bias = machine(vectors(frame), frame["sign"].to_numpy())
        return pd.DataFrame([(int(frame["pair"].iloc[0]), weights.tobytes(), bias)], columns=["pair", "w", "b"])

    both = sample.join(F.broadcast(sides), "lang")  # at most two rows per pair of languages
    trained = both.groupBy("pair").applyInPandas(train, "pair int, w binary, b double")
    return {pairs[r["pair"]]: (np.frombuffer(r["w"], np.float32), r["b"]) for r in trained.collect()}


def identify(df: DataFrame, text: str, models: Models, into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``df`` with the language and the score behind them; ``into`` names these two."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            found = [models.predict(t) for t in block.column(text).to_pylist()]
            block = block.append_column(into[0], pa.array([name for name, _ in found], pa.string()))
            block = block.append_column(into[1], pa.array([sure for _, sure in found], pa.float64()))
            yield from block.to_batches()

    added = [T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))
