"""Quality rules of documents and of the hosts they come from, in DataFrame operations only.

Each document is measured once. Per host, failures of each rule are counted and their rate is shrunk
towards the corpus by a beta prior that is fitted to all hosts by moments: a host with few documents
stays near the corpus rate, a large one keeps its own. A host whose shrunk rate of any rule is above
the limit fails, and its verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import checkpoints, stored
from hirelens.operators.skew import lookup
from hirelens.operators.staging import with_once

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
RULES = ("base", "symbols", "lines")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(tokens: str, window: int) -> Column:
    """Words of the array column ``tokens`` that lie in a window found twice or more in it.

    A first pass over hashes tells texts without any repeat, which is exact; only the others sort
    their windows, as strings.
    """
    array = F.col(tokens)
    size = F.size(array)
    ahead = range(1, window)
    starts = F.greatest(size - (window - 1), F.lit(0))
    hashes = F.slice(
        F.transform(array, lambda w, i: F.xxhash64(w, *[F.get(array, i + k) for k in ahead])),
        F.lit(1),
        starts,
    )
    any_repeat = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    windows = F.slice(
        F.transform(
            array,
            lambda w, i: F.struct(
                F.concat_ws(" ", w, *[F.get(array, i + k) for k in ahead]).alias("s"), i.alias("i")
            ),
        ),
        F.lit(1),
        starts,
    )

    def places(ordered: Column) -> Column:
        equal = lambda row, other: F.coalesce(row["s"] == F.get(ordered, other)["s"], F.lit(False))
        hits = F.filter(
            ordered, lambda row, at: F.when(at > 0, equal(row, at - 1)).otherwise(False) | equal(row, at + 1)
        )
        return F.sort_array(F.transform(hits, lambda row: row["i"]))

    def covered(at: Column) -> Column:
        steps = F.zip_with(
            F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))),
            F.slice(at, F.lit(1), F.greatest(F.size(at) - 1, F.lit(0))),
            lambda later, earlier: F.least(later - earlier, F.lit(window)),
        )
        total = F.aggregate(steps, F.lit(window), lambda total, step: total + step)
        return F.when(F.size(at) > 0, total).otherwise(0)

    exact = let(let(F.sort_array(windows), places), covered)
    return F.when((size > window) & any_repeat, exact).otherwise(0).cast("bigint")


def measures(df: DataFrame, key: str, text: str, host: str, window: int = 5) -> DataFrame:
    """``key, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` per row.

    A null text is an empty one: all counts are zero.
    """
    rows = df.select(
        F.col(key).alias("key"),
        F.col(host).alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    rows = with_once(
        rows, {"tokens": F.array_remove(F.split("text", SPACE, -1), ""), "lines": lines}
    )
    return rows.select(
        "key",
        "host",
        F.size("tokens").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("tokens", "")).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace("text", NOT_SYMBOL, "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words("tokens", window).alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
    )


def failures() -> dict[str, Column]:
    """Rule -> whether a measured document fails it."""
    return {
        "base": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }


def beta_priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Rule -> mean and strength (a + b) of the beta prior, by moments over all hosts.

    The variance between hosts is what their rates vary beyond what their sizes explain. Without
    any, the strength is ``1e9`` (hosts are alike); without documents the mean is zero. What comes
    to the driver is one row.
    """
    parts = [F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n")]
    for r in RULES:
        parts += [
            F.sum(r).alias(f"f_{r}"),
            F.sum(F.col(r).cast("double") * F.col(r) / F.col("n")).alias(f"q_{r}"),
        ]
    row = hosts.agg(*parts).first()
    priors = {}
    for r in RULES:
        n = row["n"] or 0
        mean = row[f"f_{r}"] / n if n else 0.0
        noise = mean * (1 - mean)
        spread = (row[f"q_{r}"] / n - mean * mean if n else 0.0) - noise * row["hosts"] / max(n, 1)
        priors[r] = (mean, max(noise / spread - 1, 1.0) if spread > 1e-12 else 1e9)
    return priors


def host_verdicts(measured: DataFrame, limit: float) -> DataFrame:
    """``host, n, failed`` for each host that is not null; ``measured`` has the rules as columns."""
    hosts = stored(
        measured.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("bigint")).alias(r) for r in RULES]),
        "hosts",
    )
    failed = F.lit(False)
    for r, (mean, strength) in beta_priors(hosts).items():
        rate = (F.col(r) + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
        failed = failed | (rate > limit)
    return hosts.select("host", "n", failed.alias("failed"))


def judge(
    df: DataFrame, key: str, text: str, host: str, window: int = 5, limit: float = 0.5
) -> DataFrame:
    """Measures of every row with ``base_failed, host_failed, kept``.

    A document is kept if it passes the base rule and its host passes. Rows with a null host have
    no host verdict and stand on the base rule alone. Null texts are empty texts, which fail the
    base. Rows with null or repeated keys are judged like all others, each on its own.
    """
    checkpoints(df.sparkSession)
    measured = stored(measures(df, key, text, host, window).withColumns(failures()), "measures")
    joined = lookup(measured, host_verdicts(measured, limit), "host", "n")
    host_failed = F.coalesce("failed", F.lit(False))
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.col("base").alias("base_failed"),
        (~F.col("base") & ~host_failed).alias("kept"),
        host_failed.alias("host_failed"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) > 5)
), repeats AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1
), steps AS (
  SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS step
  FROM repeats
), covered AS (SELECT doc_id, sum(step)::BIGINT AS n FROM steps GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM d LEFT JOIN covered USING (doc_id)
), r AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base,
    10 * n_symbols > word_chars AS symbols, 10 * n_dup_lines > 3 * n_lines AS dup
  FROM m
), counts AS (
  SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS f
  FROM (SELECT source, unnest(['base', 'symbols', 'lines']) AS rule,
               unnest([base, symbols, dup]) AS failed FROM r WHERE source IS NOT NULL)
  GROUP BY source, rule
), moments AS (
  SELECT rule, sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS square, count(*) / sum(n) AS share
  FROM counts GROUP BY rule
), spreads AS (
  SELECT rule, mean, square - mean * mean - mean * (1 - mean) * share AS spread FROM moments
), priors AS (
  SELECT rule, mean, CASE WHEN spread > 1e-12
    THEN greatest(mean * (1 - mean) / spread - 1, 1) ELSE 1e9 END AS strength FROM spreads
), hosts AS (
  SELECT source, bool_or((f + mean * strength) / (n + strength) > 0.5) AS failed
  FROM counts JOIN priors USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base AS base_failed,
  NOT base AND NOT coalesce(failed, FALSE) AS kept, coalesce(failed, FALSE) AS host_failed
FROM r LEFT JOIN hosts USING (source)
"""
