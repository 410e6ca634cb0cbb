"""A training-data pipeline over the documents table, in stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet and reads it again for the next stage.  All
stages but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.llm import decontam, langid, mixing, registry, simhash, toxicity
from opsmetrics.llm.common import store, table

# A text of which less than this share of n-grams belongs to its best language is in none of them,
# nor is one below the language's own floor, which comes from held-out texts (langid.floors).
LEAST_LANGUAGE = 0.1
SHINGLE, DISTANCE = simhash.SHINGLE, simhash.DISTANCE


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in none of the learned languages go."""
    model = registry.language_model(spark, sf_dir)
    floor = langid.floor_of(F.col("__language.lang_pred"), registry.language_floors(spark, sf_dir, model))
    found = langid.identify(docs, model, "__language")
    known = (F.col("__language.lang_pred") != langid.UNKNOWN) & (F.col("__language.score") >= F.greatest(floor, F.lit(LEAST_LANGUAGE)))
    return found.filter(known).drop("__language")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    found = toxicity.scored(docs, registry.toxicity_model(spark, sf_dir), "__toxicity")
    return found.filter(F.col("__toxicity.score") < toxicity.THRESHOLD).drop("__toxicity")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest id stays."""
    return simhash.keep_one(docs, SHINGLE, DISTANCE)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; a document of which no word is left goes."""
    cut = decontam.clean(docs.withColumn("__was", F.col("text")), table(spark, sf_dir, "benchmark"))
    changed = ~F.col("text").eqNullSafe(F.col("__was"))
    cut = cut.filter(~(changed & (mixing.word_count(F.col("text")) == 0)))
    return cut.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast("long")).drop("__was")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their number of copies."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language ID", language),
    ("toxicity", toxic),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing", mix),
]

# The learned stages have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"pipeline-{i}")
    return docs
