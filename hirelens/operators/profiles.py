"""Profiles against postings: coverage, match, gap, fit, ranking and their evaluation.

``pair_up`` decides which posting meets which profile: those of the same role. Profiles made by
``ideal_profiles`` are at most one per role and seniority, so a posting meets five or so. All scores
are then columns of the pair. Skill weights are one small map, no larger than the vocabulary; add
it to the pairs as a column, since lambdas cannot hold the subquery it comes from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens import rules, schemas
from hirelens.functions.dates import years_bucket
from hirelens.functions.text import bind
from hirelens.operators.market import (
    seniority_rank,
    skill_cooccurrence,
    skill_frequency,
    with_all_skills,
)
from hirelens.session import shared_dir
from hirelens.operators.skew import lookup, rank_by_score, top_k


def ideal_profiles(parsed: DataFrame, min_share: float = 0.3) -> DataFrame:
    """One profile per role and seniority: the skills at least ``min_share`` of its postings name,
    and the mean of the years they ask for."""
    by = ["role_type", "seniority_level"]
    skills = (
        skill_frequency(parsed, by)
        .filter(F.col("share") >= min_share)
        .groupBy(*by)
        .agg(F.array_sort(F.collect_set("skill")).alias("candidate_skills"))
    )
    years = parsed.groupBy(*by).agg(F.round(F.avg("min_years_experience")).cast("int").alias("years"))
    named = skills.join(years, by).select(
        F.concat_ws(" | ", *by).alias("profile_id"),
        F.col("role_type").alias("standardized_role"),
        "seniority_level",
        "candidate_skills",
        F.col("years").alias("experience_years"),
        F.lit("inferred").alias("derived_from"),
    )
    return schemas.conform(named, schemas.PROFILE)


def pair_up(jobs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Postings beside the profiles of their role. The profile's seniority is ``profile_level``."""
    right = profiles.select(
        "profile_id",
        F.col("standardized_role").alias("role_type"),
        F.col("seniority_level").alias("profile_level"),
        "candidate_skills",
        "experience_years",
    )
    return with_all_skills(jobs).join(right, "role_type")


def _as_map(table: DataFrame, key: str, value: Column) -> Column:
    """A vocabulary-sized table as one map value for all rows."""
    entries = F.collect_list(F.struct(F.col(key), value.cast("double")))
    return table.agg(F.map_from_entries(entries)).scalar()


def skill_demand(parsed: DataFrame) -> Column:
    """Map skill -> share of all postings naming it."""
    return _as_map(skill_frequency(parsed, []), "skill", F.col("share"))


def skill_idf(parsed: DataFrame) -> Column:
    """Map skill -> ``ln(N / df)``."""
    rarity = F.ln(F.col("postings") / F.col("n"))
    return _as_map(skill_frequency(parsed, []), "skill", rarity)


def _weight(skills: Column, weights: Column, power: int = 1) -> Column:
    """Sum of the weights of a set of skills."""
    return F.aggregate(
        skills,
        F.lit(0.0),
        lambda total, s: total
        + F.pow(F.coalesce(F.try_element_at(weights, s), F.lit(0.0)), F.lit(power)),
    )


def skills_coverage(required: Column, held: Column, demand: Column) -> Column:
    """Share of the required skills that are held, weighted by demand; null without any."""
    whole = _weight(required, demand)
    return F.when(whole > 0, _weight(F.array_intersect(required, held), demand) / whole)


def match_score(wanted: Column, held: Column, idf: Column) -> Column:
    """Cosine of the two skill sets as TF-IDF vectors, in [0, 1]; 0 when one is empty."""
    norms = F.sqrt(_weight(wanted, idf, 2) * _weight(held, idf, 2))
    shared = _weight(F.array_intersect(wanted, held), idf, 2)
    return F.when(norms > 0, shared / norms).otherwise(0.0)


def rare_prefix(skills: Column, idf: Column, similarity: float) -> Column:
    """The rarest skills of a set that it must share with any set of at least that match score.

    The common part of two such sets weighs at least ``similarity^2`` of either. Going from rare to
    common, the first common skill therefore comes while that much is still ahead in both.
    """
    weight = lambda s: F.pow(F.coalesce(F.try_element_at(idf, s), F.lit(0.0)), F.lit(2))
    ordered = F.array_sort(F.transform(skills, lambda s: F.struct((-weight(s)).alias("w"), s.alias("s"))))

    def cut(rows: Column) -> Column:
        ahead = lambda i: F.aggregate(
            F.slice(rows, i + 1, F.size(rows)), F.lit(0.0), lambda total, r: total - r["w"]
        )
        kept = F.filter(rows, lambda r, i: ahead(i) >= F.lit(similarity**2 * (1 - 1e-9)) * ahead(F.lit(0)))
        return F.transform(kept, lambda r: r["s"])

    return bind(ordered, cut)


def best_profiles(
    jobs: DataFrame,
    profiles: DataFrame,
    idf: Column,
    key: str,
    k: int = 3,
    similarity: float = 0.5,
) -> DataFrame:
    """``key, profile_id, score, rank``: the ``k`` best matches of each posting among any number of
    profiles, as far as their match score reaches ``similarity``; ties go by ``profile_id``.

    Only pairs that share a skill of both rare prefixes are scored, which loses none. Postings with
    the same skills are one until the end. Scores are compared to nine decimals, below which they
    are rounding errors.
    """
    named = with_all_skills(jobs).select(key, "skills")
    named = named.withColumn("_set", F.array_join(F.array_sort("skills"), "|"))
    sets = named.groupBy("_set").agg(F.first("skills").alias("wanted"), F.count(F.lit(1)).alias("_n"))
    sets = sets.withColumn("idf", idf)
    held = profiles.select("profile_id", F.col("candidate_skills").alias("held")).withColumn("idf", idf)
    left = sets.select("_set", F.explode(rare_prefix(F.col("wanted"), F.col("idf"), similarity)).alias("s"))
    right = held.select("profile_id", F.explode(rare_prefix(F.col("held"), F.col("idf"), similarity)).alias("s"))
    met = left.join(right, "s").select("_set", "profile_id").distinct()
    pairs = met.join(sets, "_set").join(held.drop("idf"), "profile_id")
    score = F.round(match_score(F.col("wanted"), F.col("held"), F.col("idf")), 9)
    scored = pairs.select("_set", "_n", "profile_id", score.alias("score")).filter(
        F.col("score") >= similarity
    )
    best = top_k(scored, ["_set"], [F.desc("score"), F.col("profile_id")], k)
    table = best.groupBy("_set", "_n").agg(
        F.collect_list(F.struct("profile_id", "score", "rank")).alias("best")
    )
    found = lookup(named.select(key, "_set"), table, "_set", "_n", [key])
    return found.select(key, F.inline("best"))


def explain_match(wanted: Column, held: Column, idf: Column, k: int = 3) -> Column:
    """The ``k`` shared skills that add most to the match: ``array<struct(weight, skill)>``."""
    entries = F.transform(
        F.array_intersect(wanted, held),
        lambda s: F.struct(
            F.pow(F.coalesce(F.try_element_at(idf, s), F.lit(0.0)), F.lit(2)).alias("weight"),
            s.alias("skill"),
        ),
    )
    ordered = F.array_sort(
        entries,
        lambda x, y: F.when(x["weight"] > y["weight"], -1)
        .when(x["weight"] < y["weight"], 1)
        .when(x["skill"] < y["skill"], -1)
        .when(x["skill"] > y["skill"], 1)
        .otherwise(0),
    )
    return F.slice(ordered, 1, k)


def missing_skills(required: Column, held: Column) -> Column:
    return F.array_except(required, held)


def skill_gap(pairs: DataFrame) -> DataFrame:
    """Per profile and missing skill: how many of its role's postings require it."""
    missing = missing_skills(F.col("skills_required"), F.col("candidate_skills"))
    return (
        pairs.select("profile_id", F.explode(missing).alias("skill"))
        .groupBy("profile_id", "skill")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def seniority_fit(years: Column, level: Column) -> Column:
    """1 when the level of the years is the target level, less by a third per level apart."""
    top = len(rules.SENIORITY_LEVELS) - 1
    apart = F.abs(seniority_rank(years_bucket(years)) - seniority_rank(level))
    return 1.0 - apart / top


def role_alignment(parsed: DataFrame, profiles: DataFrame) -> DataFrame:
    """Share of the role's skill demand each profile holds, over all skills and over tools.

    A role has at most as many rows as the vocabulary has skills.
    """
    demand = skill_frequency(parsed, ["role_type"]).withColumn(
        "tool", F.array_contains(F.lit(list(rules.TOOLS)), F.col("skill")).cast("int")
    )
    joined = demand.join(
        profiles.select("profile_id", F.col("standardized_role").alias("role_type"), "candidate_skills"),
        "role_type",
    )
    held = F.array_contains("candidate_skills", F.col("skill")).cast("int")
    share = F.col("share")
    tool_share = share * F.col("tool")
    return joined.groupBy("profile_id").agg(
        (F.sum(share * held) / F.sum(share)).alias("skill_alignment"),
        F.when(F.sum(tool_share) > 0, F.sum(tool_share * held) / F.sum(tool_share)).alias(
            "tool_alignment"
        ),
    )


def combo_rarity(parsed: DataFrame, profiles: DataFrame) -> DataFrame:
    """Mean lift of the skill pairs of each profile; a pair never seen together counts as 0."""
    pairs = F.expr(
        "flatten(transform(candidate_skills, (a, i) -> transform("
        "slice(candidate_skills, i + 2, size(candidate_skills)), b -> named_struct('a', a, 'b', b))))"
    )
    wanted = profiles.select("profile_id", F.inline(pairs))
    lifts = skill_cooccurrence(parsed).select("a", "b", "lift")
    return (
        wanted.join(lifts, ["a", "b"], "left")
        .groupBy("profile_id")
        .agg(F.avg(F.coalesce("lift", F.lit(0.0))).alias("mean_lift"))
    )


def rank_profiles(
    scored: DataFrame, keys: Sequence[str] = ("role_type", "seniority_level")
) -> DataFrame:
    """Profiles ranked by their mean score over the postings of a role and seniority.

    ``scored`` has ``profile_id``, the keys and a ``score`` in [0, 1] per pair.
    """
    shared_dir(scored.sparkSession)
    means = scored.groupBy(*keys, "profile_id").agg(F.avg("score").alias("score")).checkpoint()
    return rank_by_score(means, keys, "score")


def ranking_metrics(
    df: DataFrame, query: str, item: str, score: str, relevance: str, k: int = 10
) -> DataFrame:
    """NDCG@k and reciprocal rank of the first relevant item, per query.

    Only the best ``k`` per query are ranked. The first relevant item's rank is the number of items
    before it plus one: a maximum, then a count.
    """
    rows = df.select(query, item, score, relevance)

    def dcg(order: Sequence[Column], name: str) -> DataFrame:
        gain = (F.pow(F.lit(2.0), F.col(relevance)) - 1) / F.log2(F.col("rank") + 1.0)
        return top_k(rows, [query], order, k).groupBy(query).agg(F.sum(gain).alias(name))

    by_score = dcg([F.desc(score), F.col(item)], "dcg")
    ideal = dcg([F.desc(relevance), F.col(item)], "ideal")
    place = F.struct(F.col(score).alias("s"), (-F.col(item)).alias("i"))
    per_query = rows.groupBy(query).agg(
        F.count(F.lit(1)).alias("items"),
        F.max(F.when(F.col(relevance) > 0, place)).alias("_best"),
    )
    ranks = (
        lookup(rows, per_query, query, "items")
        .groupBy(query)
        .agg(
            F.first("items").alias("items"),
            F.when(F.count("_best") > 0, 1 / (F.count_if(place > F.col("_best")) + 1)).alias("_rr"),
        )
    )
    joined = by_score.join(ideal, query).join(ranks, query)
    return joined.select(
        query,
        "items",
        F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).alias("ndcg"),
        F.coalesce("_rr", F.lit(0.0)).alias("reciprocal_rank"),
    )


def calibration(
    df: DataFrame, predicted: Column, actual: Column, bins: int = 10, steps: int = 10_000
) -> DataFrame:
    """Mean prediction against mean outcome per decile of the predictions (in [0, 1]), whether they are
    within 5 %, and the outcome that a rising curve through all deciles gives (``calibrated``).

    A value's bin is how many tenths of the rows lie below it, so equal predictions share a bin, and
    a bin may be missing where many are equal. Cuts are exact: rows are counted per value, values
    below come from a window over steps of the range and one over the values of a step. Rows without
    prediction or outcome are left out. ``calibrated`` pools neighbours that fall (it is the largest,
    over bins in front, of the smallest mean outcome from there to any bin behind).
    """
    rows = df.select(predicted.cast("double").alias("p"), actual.cast("double").alias("y"))
    values = rows.filter("p is not null and y is not null").groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")
    )
    values = values.withColumn("step", F.floor(F.col("p") * steps))
    per_step = values.groupBy("step").agg(F.sum("n").alias("in_step"))
    before = (Window.unboundedPreceding, -1)
    under = F.sum("in_step").over(Window.orderBy("step").rowsBetween(*before))  # at most steps + 1 rows
    everything = F.sum("in_step").over(Window.partitionBy())
    per_step = per_step.select(
        "step", F.coalesce(under, F.lit(0)).alias("under"), everything.alias("everything")
    )
    within = F.sum("n").over(Window.partitionBy("step").orderBy("p").rowsBetween(*before))
    placed = values.withColumn("within", F.coalesce(within, F.lit(0))).join(per_step, "step")
    bucket = F.expr(f"({bins} * (under + within)) div everything").cast("int")
    means = placed.groupBy(bucket.alias("bin")).agg(
        F.sum("n").alias("n"), F.sum(F.col("p") * F.col("n")).alias("p"), F.sum("y").alias("y")
    )
    # one row with the bins in order: at most ``bins`` of them
    ordered = means.agg(F.sort_array(F.collect_list(F.struct("bin", "n", "p", "y"))).alias("b"))
    mean = "aggregate(slice(b, j, k - j + 1), 0D, (t, x) -> t + x.y) / aggregate(slice(b, j, k - j + 1), 0L, (t, x) -> t + x.n)"
    rising = (
        "transform(b, (x, i) -> struct(x.bin, x.n, x.p / x.n as predicted, x.y / x.n as observed,"
        " array_max(transform(sequence(1, i + 1), j -> array_min(transform(sequence(i + 1, size(b)),"
        f" k -> {mean})))) as calibrated))"
    )
    found = ordered.select(F.inline(F.expr(rising)))
    error = F.abs(F.col("predicted") - F.col("observed"))
    return found.select(
        "bin", "n", "predicted", "observed", error.alias("error"), (error <= 0.05).alias("within"), "calibrated"
    )
