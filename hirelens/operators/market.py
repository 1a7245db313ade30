"""Market aggregates over parsed postings.

Everything counts skills, and the skills of a posting are a set out of a fixed vocabulary, so a row
expands to a bounded number of skills or skill pairs. Counts combine before the shuffle and what
follows works on the counts. Totals travel as rows of the same aggregate, so the skills are read
once per report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens import rules
from hirelens.functions.matching import string_array
from hirelens.functions.skills import skill_union

ALL = ""  # stands for "any skill" in an aggregate


def with_all_skills(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn(
        "skills", skill_union(F.col("skills_required"), F.col("skills_optional"))
    )


def seniority_rank(level: Column) -> Column:
    """0 for the lowest level; null for ``Unknown``."""
    return F.nullif(F.array_position(string_array(rules.SENIORITY_LEVELS), level), F.lit(0)) - 1


def _skill_counts(parsed: DataFrame, by: Sequence[str], **extra: Column) -> DataFrame:
    """Postings per ``by`` and skill, with the total of each ``by`` under the skill ``ALL``."""
    skills = F.concat(F.array(F.lit(ALL)), F.col("skills"))
    exploded = with_all_skills(parsed).select(
        *by, *[c.alias(n) for n, c in extra.items()], F.explode(skills).alias("skill")
    )
    return exploded.groupBy(*by, "skill").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in extra]
    )


def _with_totals(counts: DataFrame, by: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Counts per skill beside the totals of their ``by`` group.

    A window over the counts, with a row per skill of the vocabulary, and not a join with filtered
    counts: the filter would be pushed below the aggregate and the postings read again.
    """
    group = Window.partitionBy(*by)
    totals = {
        t: F.max(F.when(F.col("skill") == ALL, F.col(c))).over(group) for c, t in columns.items()
    }
    return counts.withColumns(totals).filter(F.col("skill") != ALL)


def skill_frequency(
    parsed: DataFrame, by: Sequence[str] = ("role_type", "seniority_level")
) -> DataFrame:
    """Postings and share of postings naming each skill, per role and seniority."""
    counts = _with_totals(_skill_counts(parsed, by), by, {"n": "postings"})
    return counts.withColumn("share", F.col("n") / F.col("postings"))


def skill_cooccurrence(parsed: DataFrame) -> DataFrame:
    """``a, b, n, support, lift`` of every skill pair with ``a < b``.

    Pairs are made inside a posting, whose skills are a subset of the vocabulary; there is no self
    join. The pair ``(a, a)`` carries the count of the skill, which reaches the other pairs through
    windows over the counts, of at most one row per skill.
    """
    pairs = F.expr(
        "flatten(transform(skills, (a, i) -> transform(slice(skills, i + 1, size(skills)),"
        " b -> named_struct('a', a, 'b', b))))"
    )
    counts = (
        with_all_skills(parsed)
        .select(F.inline(pairs))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    single = F.when(F.col("a") == F.col("b"), F.col("n"))
    known = counts.withColumns(
        {
            "n_a": F.max(single).over(Window.partitionBy("a")),
            "n_b": F.max(single).over(Window.partitionBy("b")),
            "total": parsed.agg(F.count(F.lit(1))).scalar(),
        }
    )
    n = F.col("n")
    return known.filter("a < b").select(
        "a",
        "b",
        "n",
        (n / F.col("total")).alias("support"),
        (n * F.col("total") / (F.col("n_a") * F.col("n_b"))).alias("lift"),
    )


def skill_motifs(parsed: DataFrame, min_support: float = 0.05, sizes=(2, None)) -> DataFrame:
    """Frequent skill sets within a range of sizes: ``items`` (sorted), ``n``."""
    baskets = with_all_skills(parsed).select("skills")
    found = FPGrowth(itemsCol="skills", minSupport=min_support).fit(baskets).freqItemsets
    low, high = sizes
    wanted = F.size("items").between(low, high) if high else F.size("items") >= low
    return found.filter(wanted).select(
        F.array_sort("items").alias("items"), F.col("freq").alias("n")
    )


def skill_seniority_by_region(parsed: DataFrame, region: str = "country") -> DataFrame:
    """Per region and skill: postings, how many of them are senior, and the correlation of
    "names the skill" with "is senior" among postings of known seniority."""
    known = parsed.filter(F.col("seniority_level") != rules.UNKNOWN)
    senior = (seniority_rank(F.col("seniority_level")) >= 2).cast("bigint")
    counts = _skill_counts(known, [region], senior=senior)
    table = _with_totals(counts, [region], {"n": "postings", "senior": "all_senior"})
    n, s, k, t = (F.col(c).cast("double") for c in ("postings", "all_senior", "n", "senior"))
    spread = F.sqrt(k * (n - k) * s * (n - s))
    return table.select(
        region,
        "skill",
        "n",
        "senior",
        "postings",
        F.when(spread > 0, (n * t - k * s) / spread).alias("correlation"),
    )


def correlation_matrix(df: DataFrame, features: Mapping[str, Column]) -> DataFrame:
    """``a, b, correlation`` of every pair of numeric features, in one aggregate."""
    names = list(features)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    values = df.select(*[c.cast("double").alias(n) for n, c in features.items()])
    row = values.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}|{b}").alias("correlation"))
        for a, b in pairs
    ]
    return row.select(F.inline(F.array(*cells)))


def skill_trend(parsed: DataFrame, date: str = "date_posted_normalized") -> DataFrame:
    """Postings per skill and month, those of the month before, the growth between, and the slope.

    Every skill has a row for each month from the first to the last that any posting has; months
    without one count zero. ``slope`` is the change of postings per month that fits all months of the
    skill best, null for a single month; ``growth`` is null behind an empty month. Windows run over a
    skill's months.
    """
    monthly = (
        with_all_skills(parsed)
        .filter(F.col(date).isNotNull())
        .select(F.trunc(date, "month").alias("month"), F.explode("skills").alias("skill"))
        .groupBy("skill", "month")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ends = monthly.agg(F.min("month").alias("_from"), F.max("month").alias("_to"))  # one row
    months = F.explode(F.sequence("_from", "_to", F.expr("interval 1 month"))).alias("month")
    calendar = monthly.select("skill").distinct().join(F.broadcast(ends)).select("skill", "_from", months)
    counted = calendar.join(monthly, ["skill", "month"], "left").select(
        "skill",
        "month",
        F.coalesce("_n", F.lit(0)).alias("n"),
        F.months_between("month", "_from").cast("int").alias("_place"),
    )
    by_skill = Window.partitionBy("skill")
    found = counted.withColumns(
        {
            "previous": F.lag("n").over(by_skill.orderBy("month")),
            "slope": F.when(F.count("n").over(by_skill) > 1, F.regr_slope("n", "_place").over(by_skill)),
        }
    )
    growth = F.when(F.col("previous") > 0, F.col("n") / F.col("previous") - 1)
    return found.select("skill", "month", "n", "previous", growth.alias("growth"), "slope")


def recent_window(df: DataFrame, date: str, reference: Column, months: int = 24) -> DataFrame:
    """Rows of the last ``months`` months before ``reference``."""
    return df.filter(F.col(date).between(F.add_months(reference, -months), reference))


# FIXED VALUES: canonical title -> family
ROLE_FAMILIES = [
    ("Data Scientist", "Data Science"), ("Applied Scientist", "Data Science"),
    ("Statistician", "Data Science"), ("Quantitative Analyst", "Data Science"),
    ("Quantitative Researcher", "Data Science"), ("Machine Learning Engineer", "ML Engineering"),
    ("AI Engineer", "ML Engineering"), ("GenAI / LLM Engineer", "ML Engineering"),
    ("Research Scientist", "Research"), ("Research Engineer", "Research"),
    ("Data Analyst", "Data Analytics"), ("Analytics Engineer", "Data Analytics"),
    ("Data Engineer", "Data Engineering"),
]


def role_family(title: Column, families=ROLE_FAMILIES, other: str = "Other") -> Column:
    """Family of a canonical title."""
    return F.coalesce(*[F.when(title == t, F.lit(f)) for t, f in families], F.lit(other))
