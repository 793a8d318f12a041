"""Registered queries of the operators for training data, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.llm.decontaminate import benchmark_matches
from nestweave.llm.hard_negatives import hard_negatives
from nestweave.llm.html_text import extract_text
from nestweave.llm.language import identify_languages
from nestweave.llm.near_duplicates import near_duplicates
from nestweave.llm.pii import KINDS, find_personal_data, joined
from nestweave.llm.quality import judge_quality
from nestweave.llm.semantic_votes import score_quality
from nestweave.llm.sentencepiece_codec import BLANK, decode, encode
from nestweave.llm.token_counts import count_tokens
from nestweave.llm.toxicity import score_toxicity
from nestweave.llm.urls import judge_urls
from nestweave.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with equivalent SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts and a digest of the base kinds, all spans."""
    base = tuple(kind for kind in KINDS if kind.base)
    found = find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(F.size(f"pii.{kind.name}").cast("long").alias(f"n_{kind.name}") for kind in base),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"),
    )


@query()
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Which benchmark items which documents hold, and where."""
    return benchmark_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = decode(encode(table(spark, folder, "documents"), path), path)
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(BLANK), F.lit(" "))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "n_chunks",
        F.xxhash64("ids").alias("ids_hash"),
        (F.col("decoded") == text).alias("round_trip"),
        "ids",
    )


@query()
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL, by rule or by trees."""
    return judge_urls(table(spark, folder, "pages"))


@query()
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Rules and perplexity bands on every document."""
    judged = judge_quality(table(spark, folder, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_prob", "lower", "upper"
    )


@query()
def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, folder, "pages"))


@query()
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near copies of every document, on shingles of four words."""
    return near_duplicates(table(spark, folder, "documents"), size=4)


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every page."""
    return identify_languages(table(spark, folder, "pages"), table(spark, folder, "documents"))


@query(
    """
    WITH v AS (
      SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * c::DOUBLE) for c in embedding] AS x
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([1 for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
    s AS (
      SELECT a.id AS anchor, a.label AS own, b.id, b.label, list_dot_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id),
    p AS (
      SELECT * FROM s WHERE own = label
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
    n AS (
      SELECT p.anchor, p.id AS positive, p.score AS positive_score, s.id, s.score,
             row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND s.own <> s.label
        AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
    SELECT anchor AS anchor_id, positive AS positive_id, rank::INTEGER AS rank, id AS negative_id,
           positive_score, score AS negative_score
    FROM n WHERE rank <= 3
    """
)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 50th vector; the labels of every 7th are moved by one."""
    moved = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    vectors = table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0)


@query()
def op12_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding along the four leading components."""
    return whiten(table(spark, folder, "embeddings"))
