import os

import pytest

from opsmetrics.llm import tokencount as tc

pytestmark = pytest.mark.skipif(not os.path.exists(tc.RANKS), reason="tokenizer file not present")
DOC = "doc_id long, text string, n_tokens string, n_docs string"


def test_histogram_and_limits_match_brute_force(spark):
    texts = ["", None, "a", "hello world", "Grüße, 123!", "x " * 700, "<|endoftext|>", "word " * 700, "hello world"] + [f"text {i} " * (i % 9) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOC)
    enc = tc.encoding(tc.RANKS)
    sizes = [len(enc.encode_ordinary(t or "")) for t in texts]
    table = tc.every_limit(tc.histogram(docs)).cache()
    rows = sorted(table.collect())
    assert [(r.n_tokens, r.n_docs) for r in rows] == [(s, sizes.count(s)) for s in sorted(set(sizes))]
    for r in rows:
        assert r.docs_at_least == sum(s >= r.n_tokens for s in sizes)
        assert r.tokens_at_least == sum(s for s in sizes if s >= r.n_tokens)
        assert r.truncated_total == sum(min(s, r.n_tokens) for s in sizes)
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
        assert abs(r.share_within - sum(s <= r.n_tokens for s in sizes) / len(sizes)) < 1e-12
    for limit in (0, 3, 100, 10_000):
        assert tc.truncated_total(table, limit) == sum(min(s, limit) for s in sizes)
    assert tc.quantile(table, 0.5) == sorted(sizes)[(len(sizes) + 1) // 2 - 1] and tc.quantile(table, 1.0) == max(sizes)


def test_encoding_round_trip():
    enc = tc.encoding(tc.RANKS)
    for t in ("naïve café", "  two  blanks ", "日本 語\n", "a" * 5000):
        assert enc.decode(enc.encode_ordinary(t)) == t


def test_empty(spark):
    table = tc.every_limit(tc.histogram(spark.createDataFrame([], DOC)))
    assert table.collect() == [] and tc.truncated_total(table, 5) == 0 and tc.quantile(table, 0.5) is None


def test_long_white_space_is_counted_like_short():
    import random

    rnd, enc = random.Random(6), tc.encoding(tc.RANKS)
    blank = [" ", "\n", "\t", "\u00a0", "\u3000", "\r\n", "\x1c"]
    for _ in range(400):
        parts = [rnd.choice(["word", "9", "!?", "'s", "é", "", "a b"]) + rnd.choice(blank) * rnd.randint(0, 12) + rnd.choice(blank) * rnd.randint(0, 3) for _ in range(8)]
        text = "".join(parts)
        assert tc.n_tokens(text, tc.RANKS, run=3) == len(enc.encode_ordinary(text)), text


def test_ten_million_blanks(spark):
    texts = [" " * 10_000_000, "a" + " " * 3_000_000 + "b", "\n" * 2_000_000 + "x"]
    df = spark.createDataFrame([(i, 0, "x", "y") for i in range(3)], "doc_id long, k int, n_tokens string, n_docs string")
    from pyspark.sql import functions as F

    text = F.when(F.col("doc_id") == 0, F.repeat(F.lit(" "), 10_000_000)).when(F.col("doc_id") == 1, F.concat(F.lit("a"), F.repeat(F.lit(" "), 3_000_000), F.lit("b")))
    rows = tc.histogram(df.withColumn("text", text.otherwise(F.concat(F.repeat(F.lit("\n"), 2_000_000), F.lit("x"))))).collect()
    assert sorted((r["n_tokens"], r["n_docs"]) for r in rows) == sorted((tc.n_tokens(t, tc.RANKS), 1) for t in texts)
