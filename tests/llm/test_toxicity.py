import itertools
import os
import random

import numpy as np
import pytest

from opsmetrics.llm import registry, toxicity as tx

DOC = "doc_id long, text string, toxic int, score string, toxicity int"
SF = "/root/testdata/sf0.1"


def test_marginals_match_all_paths():
    rnd = np.random.default_rng(2)
    for sizes in ([1], [5], [3, 1, 4], [2] * 4):
        n = sum(sizes)
        emit, moves = rnd.normal(size=n) * 2, rnd.normal(size=(2, 2))
        first = np.zeros(n, dtype=bool)
        first[np.cumsum([0, *sizes[:-1]])] = True
        p, joint = tx.marginals(emit, first, moves)
        want, pairs, at = np.zeros(n), np.zeros((2, 2)), 0
        for size in sizes:
            total = 0.0
            for path in itertools.product((0, 1), repeat=size):
                w = np.exp(sum(emit[at + i] for i in range(size) if path[i]) + sum(moves[a, b] for a, b in zip(path, path[1:])))
                total += w
            for path in itertools.product((0, 1), repeat=size):
                w = np.exp(sum(emit[at + i] for i in range(size) if path[i]) + sum(moves[a, b] for a, b in zip(path, path[1:]))) / total
                for i, s in enumerate(path):
                    want[at + i] += w * s
                for a, b in zip(path, path[1:]):
                    pairs[a, b] += w
            at += size
        assert np.allclose(p, want) and np.allclose(joint, pairs)


def _rows(rnd, n, start=0):
    say = lambda k: ["".join(rnd.choice(["ka", "ti", "mo", "ran", "su"]) for _ in range(rnd.randint(1, 4))) for _ in range(k)]
    rows = []
    for i in range(n):
        words, bad = say(rnd.randint(5, 80)), int(rnd.random() < 0.25)
        if bad:
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["Scoundrel", "blaggard"]) + rnd.choice(["", "!", "ly", "ish"]))
        rows.append((start + i, " ".join(words), bad, "x", 1))
    return rows


def test_learns_words_and_their_forms(spark):
    rnd = random.Random(3)
    train = spark.createDataFrame(_rows(rnd, 500) + [(501, None, 0, "x", 1), (502, "", 1, "x", 1), (503, "a", None, "x", 1), (None, "a", 1, "x", 1)], DOC)
    model = tx.fit(train, train)
    rows = _rows(rnd, 300, 1000)
    odd = [None, "", "...", "mo " * 60_000, "kati SCOUNDRELHOOD, İ blaggardness mo"]
    docs = spark.createDataFrame(rows + [(5000 + i, t, 0, "x", 1) for i, t in enumerate(odd)], DOC)
    got = {r["doc_id"]: r["toxicity"] for r in tx.scored(docs.drop("toxicity"), model).collect()}
    assert sum((got[i]["score"] >= tx.THRESHOLD) == bool(bad) for i, _, bad, _, _ in rows) >= 297
    assert all(got[5000 + i]["score"] < 0.5 and got[5000 + i]["spans"] == [] for i in range(4))
    text, found = odd[4], got[5004]
    assert found["score"] >= tx.THRESHOLD
    assert [text[s["start"] : s["stop"]] for s in found["spans"]] == ["SCOUNDRELHOOD", "blaggardness"]


def test_without_labels_and_empty(spark):
    one, none = spark.createDataFrame([(1, "a b", 0, "x", 1)], DOC), spark.createDataFrame([], DOC)
    model = tx.fit(one, one)
    docs = spark.createDataFrame([(1, "a b", 0, "x", 1), (2, None, 0, "x", 1)], DOC)
    assert [r["t"]["score"] for r in tx.scored(docs, model, "t").collect()] == [0.0, 0.0]
    assert tx.fit(none, none).share == 0 and tx.fit(one, none).share == 0
    assert tx.scored(none, model, "t").collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in registry.op10_toxicity(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect()
    held = [(r.toxic, got[r.doc_id]["score"]) for r in labels if got[r.doc_id]["held_out"]]
    clean, bad = [s for t, s in held if t == 0], [s for t, s in held if t == 1]
    assert sum(s >= tx.THRESHOLD for s in clean) <= 0.01 * len(clean)
    assert sum(s >= tx.THRESHOLD for s in bad) >= 0.8 * len(bad)


@pytest.mark.parametrize("n", [1, 2, 10, 70])
def test_few_labelled_rows(spark, n):
    """Parts without a document, one label only, emptied texts: every text still gets a score."""
    rows = [(i, ["kati mo", "scoundrel su", None, ""][i % 4], i % 2, "x", 1) for i in range(n)]
    train = spark.createDataFrame(rows, DOC).repartition(16)
    docs = spark.createDataFrame([(100, "scoundrel", 0, "x", 1), (101, None, 0, "x", 1)], DOC).drop("toxicity")
    got = tx.scored(docs, tx.fit(train, train)).collect()
    assert len(got) == 2 and all(0 <= r["toxicity"]["score"] <= 1 for r in got)


def test_fits_are_repeatable(spark):
    rows = _rows(random.Random(7), 60) * 2  # copies: the first in the sample's order stands for all
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    one, two = (tx.fit(d, d) for d in (spark.createDataFrame(rows, DOC).repartition(k) for k in (3, 11)))
    assert one.weights == two.weights and np.array_equal(one.moves, two.moves)
