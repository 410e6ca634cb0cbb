"""Token counts by an exact length histogram.

Every whole text is encoded once with a public tokenizer; documents are
aggregated by their encoded length.  The histogram is far smaller than the
corpus (one row for each length that occurs) and answers every context
limit exactly: with suffix sums over the lengths, documents and tokens at
or above a limit, the total after truncation, and quantiles follow without
another look at the texts.  The suffix sums run in two levels (blocks of
``BLOCK`` lengths, then the blocks), so no window holds all lengths.

The tokenizer's file is a parameter; Spark's file server hands it from the
driver to each executor, and each Python worker loads it once.  Its pattern goes
back step by step in white space, so a run of ``RUN`` or more white-space characters is cut out of
the text first, at the points where the pattern splits anyway, and merged as one piece.

Edge cases: null and empty texts have length 0 and are counted; special
token strings inside a text are ordinary text; repeated rows count as
often as they stand; an empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, store

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pattern that splits text before the merges of these rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 256
RUN = 10_000
# Fixed value: Unicode's white space, which the pattern's ``\\s`` means.
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@functools.cache
def encoding(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path) as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def n_tokens(text: str, path: str, run: int = RUN) -> int:
    """Encoded length of a text, long white-space runs as pieces of their own."""
    encode, total, at = encoding(path).encode_ordinary, 0, 0
    if len(text) >= run:
        piece = encoding(path, r"[\s\S]+").encode_ordinary  # all of it is one piece
        for found in re.finditer(f"{SPACE}{{{run},}}", text):
            # The last one before other text belongs to what follows, or is a piece alone.
            end = found.end() - (found.end() < len(text))
            total += len(encode(text[at : found.start()])) + len(piece(text[found.start() : end]))
            at = end
    return total + len(encode(text[at:]))


def encoded_length(spark: SparkSession, text: Column, path: str = RANKS) -> Column:
    spark.sparkContext.addFile(path)
    name = os.path.basename(path)

    @F.pandas_udf("long")
    def length(texts: pd.Series) -> pd.Series:
        held = SparkFiles.get(name)
        return pd.Series([n_tokens(t, held) if t else 0 for t in texts], dtype="int64")

    return length(text)


def histogram(docs: DataFrame, path: str = RANKS, text: str = "text") -> DataFrame:
    """(n_tokens, n_docs): documents of each encoded length."""
    bounded_batches(docs.sparkSession)
    return docs.select(encoded_length(docs.sparkSession, F.col(text), path).alias("n_tokens")).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def every_limit(lengths: DataFrame) -> DataFrame:
    """For each length as context limit: n_tokens, n_docs, docs_at_least, tokens_at_least, total_docs, total_tokens, truncated_total, share_within.

    ``truncated_total`` is the corpus's tokens if every document is cut to
    ``n_tokens``; ``share_within`` the share of documents that fit whole.
    """
    h = store(lengths, "lengths").withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("t", F.col("n_tokens") * F.col("n_docs"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("t").alias("bt"))
    above = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    blocks = blocks.select(
        "block", F.coalesce(F.sum("bd").over(above), F.lit(0)).alias("above_d"), F.coalesce(F.sum("bt").over(above), F.lit(0)).alias("above_t"),
        F.sum("bd").over(every).alias("total_docs"), F.sum("bt").over(every).alias("total_tokens"),
    )
    inner = W.partitionBy("block").orderBy(F.desc("n_tokens"))
    h = h.withColumns({"in_d": F.sum("n_docs").over(inner), "in_t": F.sum("t").over(inner)}).join(blocks, "block")
    h = h.withColumns({"docs_at_least": F.col("in_d") + F.col("above_d"), "tokens_at_least": F.col("in_t") + F.col("above_t")})
    cut = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    within = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    return h.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "total_docs", "total_tokens", cut.alias("truncated_total"),
                    (within / F.col("total_docs")).alias("share_within"))


def truncated_total(limits: DataFrame, limit: int) -> int:
    """Tokens of the corpus cut to ``limit``, from ``every_limit``'s table: any limit, also one that is no length."""
    at = limits.filter(F.col("n_tokens") >= limit).orderBy("n_tokens").first()
    if at is None:
        top = limits.orderBy(F.desc("n_tokens")).first()
        return top["total_tokens"] if top else 0
    return at["total_tokens"] - at["tokens_at_least"] + limit * at["docs_at_least"]


def quantile(limits: DataFrame, share: float) -> int | None:
    """The smallest length within which at least ``share`` of all documents fit."""
    at = limits.filter(F.col("share_within") >= share).orderBy("n_tokens").first()
    return at and at["n_tokens"]
