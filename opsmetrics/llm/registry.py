"""Queries of the training-data operators over the provided tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, hardneg, htmltext, katz, langid, mixing, repeats, simhash, tokencount, toxicity, urlfilter, vectorcodes
from .common import crc_mod, store, table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = htmltext.extract(pages, htmltext.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), every=20, k=20)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.every_limit(tokencount.histogram(table(spark, sf_dir, "documents")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.rule_table(spark, urlfilter.RULES)).select("page_id", "host", "path", "rule", "verdict")


def language_model(spark: SparkSession, sf_dir: str) -> langid.Filter:
    """Learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").filter(crc_mod(F.col("doc_id"), 3) != 1)
    return langid.fit(docs.select("doc_id", "text", "lang"))


def language_floors(spark: SparkSession, sf_dir: str, model: langid.Filter) -> dict[str, float]:
    """From the documents that are held out."""
    docs = table(spark, sf_dir, "documents").filter(crc_mod(F.col("doc_id"), 3) == 1)
    return langid.floors(docs.select("doc_id", "text", "lang"), model)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"))
    return langid.identify(docs, language_model(spark, sf_dir)).select("doc_id", "held_out", "language.lang_pred", "language.score")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scores(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.scan(docs, table(spark, sf_dir, "benchmark")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Field:
    """Learned from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").filter(crc_mod(F.col("doc_id"), 3) != 1).select("doc_id", "text")
    return toxicity.fit(docs, table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"))
    score = F.col("toxicity.score")
    return toxicity.scored(docs, toxicity_model(spark, sf_dir)).select(
        "doc_id", "held_out", score.alias("score"), F.when(score >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted")
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    books = vectorcodes.fit(vectors)
    coded = vectorcodes.with_label_error(store(vectorcodes.encode(vectors, books), "vector-codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vectorcodes.books_sha256(books)).alias("codebooks_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_html_text, op2_mixing, op3_nearest, op4_token_counts, op5_url_filter,
        op6_language_id, op7_language_model, op8_decontamination, op9_simhash, op10_toxicity,
        op11_vector_codes, op12_hard_negatives, op13_suffix_dedup,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": mixing.ORACLE, "op5_url_filter": urlfilter.ORACLE, "op8_decontamination": decontam.ORACLE,
            "op11_vector_codes": vectorcodes.ORACLE, "op12_hard_negatives": hardneg.ORACLE}
