import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from opsmetrics.llm import katz

DOC = "doc_id long, text string, held int, score string"
IN_WORDS = "abcdefg"


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def _model(texts):
    """Plain model: base log-probability, conditional log-probability, vocabulary, N."""
    seqs = [[x for x in _lower(t).replace("\x0b", " ").split()] + ["</s>"] for t in texts]
    c, pairs = Counter(), Counter()
    for s in seqs:
        c.update(s)
        pairs.update(zip(["<s>"] + s, s))
    n, v = sum(c.values()), len(c)
    ctx = Counter(c)
    ctx["<s>"] = len(seqs)
    d = katz.Discounts([sum(1 for x in pairs.values() if x == r) for r in range(1, katz.RANKS + 2)])
    p1 = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    seen = {}
    for (a, b), r in pairs.items():
        seen.setdefault(a, {})[b] = r
    dr = lambda r: float(d.of(np.array([r]))[0])

    def p2(a, b):
        known = seen.get(a, {})
        if b in known:
            return dr(known[b]) * known[b] / ctx[a]
        mass = 1 - sum(dr(r) * r for r in known.values()) / ctx[a] if known else 1
        return mass / (1 - sum(p1(w) for w in known)) * p1(b)

    return p1, p2, c, n


def _texts(rnd, n):
    return [" ".join(rnd.choice(IN_WORDS) + rnd.choice(["", "", "x", "Y"]) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def test_scores_match_a_plain_model(spark, monkeypatch):
    rnd = random.Random(11)
    texts = _texts(rnd, 120) + [None, "", " \t", "new words only", "a b a b a b"]
    rows = [(i, t, int(i % 4 == 0), "x") for i, t in enumerate(texts)] + [(None, "a b", 0, "x"), (1, texts[1], 0, "x"), (2**62 + 1, "b", 0, "x")]
    for keys, fan, wide in ((1 << 20, 10, 1 << 10), (8, 10, 1 << 10), (8, 3, 2), (4, 2, 3)):  # one partition; many; dealt in levels
        monkeypatch.setattr(katz, "PART_KEYS", keys)
        monkeypatch.setattr(katz, "FAN_BITS", fan)
        monkeypatch.setattr(katz, "WIDE", wide)
        docs = spark.createDataFrame(rows, DOC).repartition(5)
        levels = []
        merge = katz._groups
        with monkeypatch.context() as m:
            m.setattr(katz, "_groups", lambda asked, n: levels.append(n) or merge(asked, n))
            got = katz.scores(docs, F.col("held") == 1).collect()
        assert bool(levels) == (fan < 10) and (fan > 2 or len(levels) > 2)  # the smallest fan takes several levels
        assert len(got) == len(rows)
        p1, p2, c, n = _model([t for _, t, h, _ in rows if not h])
        want = {}
        for i, t, h, _ in rows:
            s = _lower(t).split() + ["</s>"]
            want[i] = (bool(h), len(s), sum(c[w] > 0 for w in s), n, sum(math.log10(p1(w)) for w in s),
                       sum(math.log10(p2(a, b)) for a, b in zip(["<s>"] + s, s)))
        for r in got:
            w = want[r["doc_id"]]
            assert tuple(r)[1:5] == w[:4]
            assert abs(r["base_score"] - w[4]) < 1e-9 and abs(r["score"] - w[5]) < 1e-9, (r, w)


def test_conditional_probabilities_sum_to_one():
    rnd = random.Random(12)
    p1, p2, c, _ = _model(_texts(rnd, 60))
    words = list(c) + ["unknown"]
    for a in ["<s>", *list(c)[:12], "never seen"]:
        assert abs(sum(p2(a, b) for b in words) - 1) < 1e-9


def test_without_training_rows_and_empty(spark):
    assert katz.scores(spark.createDataFrame([], DOC)).collect() == []
    (row,) = katz.scores(spark.createDataFrame([(1, "a b", 1, "x")], DOC), F.lit(True)).collect()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["base_score"] == 0 and row["score"] == 0


def test_long_text_and_discounts(spark):
    text = "the cat " * 40_000
    (row,) = katz.scores(spark.createDataFrame([(2, text, 0, "x")], DOC), F.lit(False)).collect()
    assert row["n_tokens"] == 80_001 and -50 < row["score"] < 0
    d = katz.Discounts([0] * (katz.RANKS + 1)).of(np.arange(0, 50))
    assert ((d[1:] > 0) & (d[1:] < 1)).all()


def test_partitions_of_prefixes():
    keys = np.sort(np.random.default_rng(5).integers(0, 1 << 64, 500, dtype=np.uint64))
    whole = katz._cuts(keys, 6)
    assert [int(k >> np.uint64(58)) for k in keys] == [p for p, a, e in whole for _ in range(a, e)]
    deep = [(p, keys[b:f][a:e].tolist()) for q, b, f in katz._cuts(keys, 2) for p, a, e in katz._cuts(keys[b:f], 6, q, 2)]
    assert deep == [(p, keys[a:e].tolist()) for p, a, e in whole]
    for x in ([], [3, 2**32 - 1], [2**32, 1]):
        assert katz._of_numbers(katz._numbers(np.array(x, dtype=np.int64))).tolist() == x
