"""The queries of the ten operators, one thin query each, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, language, line_dedup, media, mixing, ngram_join, substring_dedup, topics, unigram, url_filter
from .common import table

#: A parameter: the SentencePiece model whose pieces are read as a unigram vocabulary.
MODEL = os.environ.get("FLOWTIDE_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
URL_RULES = [url_filter.Rule(*x) for x in (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens: pieces of the whole text; null for null."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return unigram.count_tokens(docs, unigram.Vocabulary.read(MODEL)).select("doc_id", "n_tokens")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_dedup.decide(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, score."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "url_filter.*")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    docs = substring_dedup.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.col("substring_dedup.n_words"), F.col("substring_dedup.n_removed"), F.sha2("substring_dedup.kept", 256).alias("kept_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids, decoded_sha256, round_trip: whether decoding the ids gives the normalised text."""
    docs = unigram.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), unigram.Vocabulary.read(MODEL))
    return docs.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.col("decoded") == unigram.normalised(F.col("text"))).alias("round_trip"),
    )


#: Topics that the mix is made of.
TOPICS = 6


def mix_marginals(topic: Column) -> list[mixing.Marginal]:
    """The production mix: even sources, English at half, even topics."""
    return [
        mixing.Marginal("source_level", F.col("source"), {f"src{i}": 0.045 for i in range(20)}),
        mixing.Marginal("lang_level", F.col("lang"), {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.1}),
        mixing.Marginal("topic", topic, {f"topic{k}": 0.95 / TOPICS for k in range(TOPICS)}),
    ]


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source_level, lang_level, topic, reached_ of each, n_tokens (words), weight, p, kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    about = topics.assigner(docs, topics.learn(docs, topics=TOPICS))
    docs = docs.withColumn("about", about(F.col("text")))
    return mixing.mix(docs, mix_marginals(F.col("about.topic")), 0.5, F.col("about.n_words"), without=("text", "about")).select("doc_id", "mixing.*")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, copy_id, copies, n_links."""
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("t", "keep")


def op8_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the digest of the text's Ogg form, read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", media.media_digest(F.col("text")).alias("m")).select("doc_id", "m.*")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (null for null text)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "line_dedup.*", F.sha2("text", 256).alias("kept_sha256"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin, rejected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.train(docs, where=~F.coalesce(held, F.lit(False)))
    return language.identify(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "language.*")


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_exact_dedup, op3_url_filter, op4_substring_dedup, op5_sentencepiece, op6_mixing, op7_ngram_join, op8_ogg_media, op9_line_dedup, op10_language)}
#: The others are not to be said in SQL: searches over automata, trained models, media bytes, raking.
ORACLES = {"op2_exact_dedup": exact_dedup.ORACLE, "op4_substring_dedup": substring_dedup.ORACLE, "op9_line_dedup": line_dedup.ORACLE}


def queries() -> dict:
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
