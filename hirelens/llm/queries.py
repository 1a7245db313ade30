"""Registered queries of this subpackage and the SQL they are checked with, where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from hirelens.llm import (
    bpe,
    fill_middle,
    language_id,
    packing,
    permutation_index,
    quality_rules,
    secrets,
    simhash,
    spelling,
    substring_dedup,
    token_files,
    toxicity,
    wrapper,
)
from hirelens.llm.common import table
from hirelens.llm.token_ids import vocabulary

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), "doc_id", "text", "source")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    return toxicity.score(docs, "text", weights).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), "doc_id", "text")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(
        documents(spark, sf_dir), "doc_id", "text", vocabulary(BYTE_RANKS), public_tokenizers.PATTERN
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), "doc_id", "text", vocabulary(WORD_VOCABULARY))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir), "doc_id", "text").select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(WORD_VOCABULARY)
    files = token_files.write_files(
        documents(spark, sf_dir), "doc_id", "text", words, token_files.new_folder(spark)
    )
    return token_files.read_files(spark, files).select(
        F.col("key").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest_neighbours(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20
    )


def op9_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrapper.main_text(pages, "url", "html").select(
        "page_id",
        "url",
        F.col("_text").alias("text"),
        F.char_length("_text").cast("bigint").alias("n_chars"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir), "text")
    base = F.filter("spans", lambda s: s["kind"] != "novel")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(
        documents(spark, sf_dir), "doc_id", "text", min_length=6, min_count=5, slip=199
    )
    return spelling.variants(words, ratio=5)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    draw = fill_middle.Draw(seed=7, rate=100, spm=50)
    out = fill_middle.fill_in_middle(documents(spark, sf_dir), "doc_id", "text", draw)
    return fill_middle.restored(out).select(
        F.col("key").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = language_id.fit(docs, "doc_id", "text", "lang")
    return language_id.identify(docs.select("doc_id", "text"), "text", models).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {
    q.__name__: q
    for q in (
        op1_quality_rules,
        op2_toxicity,
        op3_simhash,
        op4_bpe,
        op5_packing,
        op6_substring_dedup,
        op7_token_files,
        op8_permutation_index,
        op9_html_wrapper,
        op10_secrets,
        op11_spelling,
        op12_fill_middle,
        op13_language_id,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op6_substring_dedup": substring_dedup.ORACLE,
    "op12_fill_middle": fill_middle.ORACLE,
}
