"""Queries of the market reports, the corpus features and the profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions import tokens as tok
from hirelens.operators import corpus, market, models, near_dup, phrases, profiles, text_match
from hirelens.plans import inputs
from hirelens.plans.inputs import parsed_table

c = F.col


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# --- market -----------------------------------------------------------------------------------


def skill_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(market.skill_frequency(parsed_table(spark, sf_dir)), "share")


def skill_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(market.skill_cooccurrence(parsed_table(spark, sf_dir)), "support", "lift")


def skill_motifs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sets of two or more skills that a tenth of the postings name."""
    found = market.skill_motifs(parsed_table(spark, sf_dir), 0.1)
    return found.select(F.array_join("items", "|").alias("items"), "n")


def skill_seniority_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(market.skill_seniority_by_region(parsed_table(spark, sf_dir)), "correlation")


def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = market.with_all_skills(parsed_table(spark, sf_dir))
    features = {
        "years": c("min_years_experience"),
        "skills": F.size("skills"),
        "tools": F.size("tools_frameworks"),
        "rank": market.seniority_rank(c("seniority_level")),
        "chars": F.length("job_description_raw"),
    }
    return rounded(market.correlation_matrix(df, features), "correlation")


def skill_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = rounded(market.skill_trend(parsed_table(spark, sf_dir)), "growth", "slope")
    return trend.withColumn("month", c("month").cast("string"))


def recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parsed_table(spark, sf_dir)
    kept = market.recent_window(df, "date_posted_normalized", F.lit("2026-02-19").cast("date"), 3)
    return kept.select("doc_id", c("date_posted_normalized").cast("string").alias("day"))


def role_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = market.role_family(c("normalized_title")).alias("family")
    return parsed_table(spark, sf_dir).groupBy(family).agg(F.count(F.lit(1)).alias("n"))


# --- corpus -----------------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents")


def _summary(name: str):
    return [F.size(name).alias("n"), F.md5(F.array_join(name, " ")).alias("hash")]


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _documents(spark, sf_dir).select("doc_id", tok.tokenize(c("text")).alias("tokens"))
    return found.select("doc_id", *_summary("tokens"))


def clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _documents(spark, sf_dir).select("doc_id", tok.tokenize(c("text")).alias("tokens"))
    cleaned = corpus.clean_tokens(found, "tokens", rules.STOP_WORDS["en"], "clean")
    return cleaned.select("doc_id", *_summary("clean"))


def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _documents(spark, sf_dir).select("doc_id", tok.tokenize(c("text")).alias("tokens"))
    pairs = found.select("doc_id", tok.ngrams(c("tokens"), 2).alias("pairs"))
    return pairs.select("doc_id", *_summary("pairs"))


def lemmatize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uses per lemma; the lemma table takes a plural s off the tokens of the conversations."""
    rows = _documents(spark, sf_dir).select(F.explode(tok.tokenize(c("text"))).alias("token"))
    words = inputs.table(spark, sf_dir, "conversations").select(
        F.explode(tok.tokenize(c("text"))).alias("token")
    )
    lemmas = words.filter(c("token").endswith("s")).distinct().withColumn(
        "lemma", F.regexp_replace("token", "s+$", "")
    )
    return corpus.lemma_counts(rows, lemmas)


def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return corpus.language_filter(docs, keep=("en", "de")).select("doc_id", "language")


def pii_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = _documents(spark, sf_dir).select("doc_id", tok.pii_mask(c("text")).alias("t"))
    return masked.select(
        "doc_id",
        F.regexp_count("t", F.lit(r"\[EMAIL\]")).alias("emails"),
        F.regexp_count("t", F.lit(r"\[IP\]")).alias("ips"),
        F.regexp_count("t", F.lit(r"\[PHONE\]")).alias("phones"),
        F.md5("t").alias("hash"),
    )


def normalize_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = inputs.postings(spark, sf_dir).select("doc_id", tok.pay(c("salary_raw")).alias("pay"))
    return paid.select("doc_id", "pay.*")


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(corpus.tfidf(_documents(spark, sf_dir), "doc_id", tok.tokenize(c("text"))), "weight")


def boilerplate_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs.postings(spark, sf_dir)
    return rounded(corpus.boilerplate_share(p, "doc_id", "company", "description", 3), "share")


def vocab_match_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of two and three words of the benchmark's texts as phrases, in all documents."""
    words = inputs.table(spark, sf_dir, "benchmark").select(tok.tokenize(c("text")).alias("ts"))
    both = F.concat(tok.ngrams(c("ts"), 2), tok.ngrams(c("ts"), 3))
    vocabulary = words.select(F.explode(both).alias("phrase"))
    hits = phrases.phrase_hits(_documents(spark, sf_dir), "doc_id", tok.tokenize(c("text")), vocabulary)
    return hits.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("hits"),
        F.count_distinct("phrase").alias("phrases"),
        F.sum("place").alias("places"),
        F.min("phrase").alias("first"),
    )


def text_match_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three benchmark texts that each document's text is most like."""
    docs = _documents(spark, sf_dir).select("doc_id", tok.tokenize(c("text")).alias("ts"))
    items = inputs.table(spark, sf_dir, "benchmark").select("item_id", tok.tokenize(c("text")).alias("ts"))
    found = text_match.text_matches(docs, items, "doc_id", "item_id", c("ts"), k=3, least=0.2)
    return rounded(found, "score")


def near_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_dup(_documents(spark, sf_dir), "doc_id", c("text"))


# --- profiles ---------------------------------------------------------------------------------


def ideal_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profiles.ideal_profiles(parsed_table(spark, sf_dir))
    return found.select(
        "profile_id",
        "standardized_role",
        "seniority_level",
        F.array_join("candidate_skills", "|").alias("candidate_skills"),
        "experience_years",
        "derived_from",
    )


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every posting with the profiles of its role. There is at most one profile per role and
    seniority, 30 in all, so broadcasting them is safe whatever the data."""
    df = parsed_table(spark, sf_dir)
    return profiles.pair_up(df, F.broadcast(profiles.ideal_profiles(df)))


def skills_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand = profiles.skill_demand(parsed_table(spark, sf_dir))
    pairs = _pairs(spark, sf_dir).withColumn("demand", demand)
    score = profiles.skills_coverage(c("skills_required"), c("candidate_skills"), c("demand"))
    return pairs.select("doc_id", "profile_id", F.round(score, 6).alias("coverage"))


def _weighted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).withColumn("idf", profiles.skill_idf(parsed_table(spark, sf_dir)))


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = profiles.match_score(c("skills"), c("candidate_skills"), c("idf"))
    return _weighted_pairs(spark, sf_dir).withColumn("score", score)


def match_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_matched(spark, sf_dir).select("doc_id", "profile_id", "score"), "score")


def best_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best of the profiles that titles and places make, for every posting."""
    df = parsed_table(spark, sf_dir)
    named = F.concat_ws(" | ", "normalized_title", "city", "country")
    made = market.with_all_skills(df).select(named.alias("profile_id"), F.explode("skills").alias("skill"))
    made = made.groupBy("profile_id").agg(F.array_sort(F.collect_set("skill")).alias("candidate_skills"))
    found = profiles.best_profiles(df, made, profiles.skill_idf(df), "doc_id", 3, 0.5)
    return rounded(found, "score")


def explain_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = profiles.explain_match(c("skills"), c("candidate_skills"), c("idf"), 2)
    pairs = _weighted_pairs(spark, sf_dir).select(
        "doc_id", "profile_id", F.posexplode(top).alias("place", "t")
    )
    return rounded(pairs.select("doc_id", "profile_id", "place", "t.*"), "weight")


def skill_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.skill_gap(_pairs(spark, sf_dir))


def seniority_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = profiles.seniority_fit(c("experience_years"), c("seniority_level"))
    return _pairs(spark, sf_dir).select("doc_id", "profile_id", F.round(fit, 6).alias("fit"))


def role_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parsed_table(spark, sf_dir)
    found = profiles.role_alignment(df, profiles.ideal_profiles(df))
    return rounded(found, "skill_alignment", "tool_alignment")


def combo_rarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parsed_table(spark, sf_dir)
    return rounded(profiles.combo_rarity(df, profiles.ideal_profiles(df)), "mean_lift")


def rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.rank_profiles(_matched(spark, sf_dir)).select(
        "role_type", "seniority_level", "profile_id", "score", "rank"
    )


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inputs.table(spark, sf_dir, "labels")
    return _documents(spark, sf_dir).select("doc_id", "source", "n_chars").join(labels, "doc_id")


def ranking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents of a source ranked by length; quality is the relevance."""
    judged = _judged(spark, sf_dir)
    return rounded(
        profiles.ranking_metrics(judged, "source", "doc_id", "n_chars", "quality", 5),
        "ndcg", "reciprocal_rank",
    )


def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A made-up probability from the length against the quality label."""
    p = c("n_chars") / (c("n_chars") + 500)
    found = profiles.calibration(_judged(spark, sf_dir), p, c("quality"))
    return rounded(found, "predicted", "observed", "error", "calibrated")


def _with_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parsed_table(spark, sf_dir)
    found = tok.tokenize(c("job_description_raw"))
    return df.select("doc_id", "role_type", found.alias("tokens"))


def archetypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every posting."""
    _, clusters = models.archetypes(_with_tokens(spark, sf_dir), "doc_id", c("tokens"), k=6, rounds=3)
    return clusters


def role_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for all postings by a model that has seen four fifths of them."""
    df = _with_tokens(spark, sf_dir)
    out = models.held_out(c("doc_id"))
    model = models.role_classifier(df.filter(~out), "doc_id", c("tokens"))
    predicted = models.predict_role(model, df, "doc_id", c("tokens"))
    return df.select("doc_id", "role_type", out.alias("held_out")).join(predicted, "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        skill_frequency, skill_cooccurrence, skill_motifs, skill_seniority_by_region,
        correlation_matrix, skill_trend, recent_window, role_family, tokenize, clean_tokens, ngrams,
        lemmatize, language_filter, pii_mask, normalize_units, tfidf, boilerplate_share,
        ideal_profiles, skills_coverage, match_score, best_profiles, explain_match, skill_gap, seniority_fit,
        role_alignment, combo_rarity, rank_profiles, ranking_metrics, calibration, archetypes,
        role_classifier, vocab_match_phrases, text_match_top,
    )
}
QUERIES["near_dup"] = near_dup_groups
