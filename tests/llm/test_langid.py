import os
import random

import numpy as np
import pytest

from opsmetrics.llm import langid, registry

DOC = "doc_id long, text string, lang string, score int, lang_pred int"
SF = "/root/testdata/sf0.01"
STEMS = {"aa": ["ka", "ti", "mo", "ran"], "bb": ["wes", "ul", "ben", "oz"], "cc": ["ka", "wes", "yri", "jé"]}


def _say(rnd, lang, n):
    return " ".join("".join(rnd.choice(STEMS[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n)) + "."


def _rows(rnd, n):
    langs = [rnd.choice(list(STEMS)) for _ in range(n)]
    return [(i, _say(rnd, lang, rnd.randint(1, 60)), lang, 0, 0) for i, lang in enumerate(langs)]


def test_learned_languages_are_told_apart(spark):
    rnd = random.Random(1)
    train = spark.createDataFrame(_rows(rnd, 300) + [(1, None, "aa", 0, 0), (2, "zz", None, 0, 0), (3, "", "bb", 0, 0)], DOC)
    model = langid.fit(train)
    assert model.langs == ["aa", "bb", "cc"]
    rows = _rows(rnd, 200)
    odd = [None, "", "123 ... 4", "ж", "日本", "K", "!!! ka ti mo"]
    docs = spark.createDataFrame(rows + [(1000 + i, t, None, 0, 0) for i, t in enumerate(odd)], DOC)
    got = {r["doc_id"]: r["language"] for r in langid.identify(docs, model).collect()}
    assert sum(got[i]["lang_pred"] == lang for i, _, lang, _, _ in rows) >= 190
    assert [got[1000 + i]["lang_pred"] for i in range(3)] == ["und"] * 3
    assert all(got[1000 + i]["lang_pred"] in model.langs for i in range(3, 7)) and got[1006]["lang_pred"] == "aa"
    assert all(0 <= x["score"] <= 1 for x in got.values())


def test_without_labels_and_empty(spark):
    none = spark.createDataFrame([(1, "some text", None, 0, 0)], DOC)
    model = langid.fit(none)
    assert [tuple(r["language"]) for r in langid.identify(none, model).collect()] == [("und", 0.0)]
    assert langid.identify(spark.createDataFrame([], DOC), model).collect() == []


def test_more_than_64_languages():
    rnd = np.random.default_rng(4)
    model = langid.Filter([f"l{i:03d}" for i in range(130)], 100_000)
    own = {i: rnd.integers(1, 2**63, 200).astype(np.uint64) for i in range(130)}
    for i, h in own.items():
        model.add(h, i)
    for i, h in own.items():
        assert int(np.argmax(model.counts(h))) == i


def test_masks_return_all_languages_and_counts_are_corrected():
    rnd = np.random.default_rng(5)
    model = langid.Filter(["a", "b", "c"], 4000)
    both = rnd.integers(1, 2**63, 500).astype(np.uint64)
    model.add(both, 0)
    model.add(both, 2)
    assert model.counts(both)[0] == pytest.approx(500) and model.counts(both)[2] == pytest.approx(500)
    strange = rnd.integers(1, 2**63, 20_000).astype(np.uint64)
    assert abs(model.counts(strange)[0]) < 0.02 * 20_000


def test_pieces_see_the_same_grams(monkeypatch):
    text = "Straße! Über 12 naïve — dog " * 40
    whole = np.sort(langid.grams(text))
    monkeypatch.setattr(langid, "PIECE", 64)
    assert np.sort(langid.grams(text)).tolist() == whole.tolist()
    assert len(langid.grams("x" * 300_000)) > 0


def test_floors_come_from_held_out_texts(spark):
    rnd = random.Random(7)
    model = langid.fit(spark.createDataFrame(_rows(rnd, 300), DOC))
    held = _rows(rnd, 200)
    low = langid.floors(spark.createDataFrame([r for r in held if r[2] != "cc"] + [(999, None, "aa", 0, 0), (998, "x", None, 0, 0)], DOC), model)
    for lang in ("aa", "bb"):
        scores = [model.predict(t) for _, t, was, _, _ in held if was == lang]
        least = min(s for got, s in scores if got == lang)
        assert langid.MARGIN * least <= low[lang] < least
    assert low["cc"] == min(low["aa"], low["bb"])
    assert langid.floors(spark.createDataFrame([], DOC), model) == {}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in registry.op6_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    held = [(got[d.doc_id]["lang_pred"], d.lang) for d in docs if got[d.doc_id]["held_out"] and got[d.doc_id]["lang_pred"] != "und"]
    assert len(held) > 200 and sum(a == b for a, b in held) >= 0.98 * len(held)


def test_every_held_out_text_counts(spark):
    """More texts than the filter's sample has."""
    rnd = random.Random(11)
    model = langid.fit(spark.createDataFrame(_rows(rnd, 300), DOC))
    held = [(i, _say(rnd, rnd.choice(["aa", "aa", "cc"]), rnd.randint(4, 9)) + _say(rnd, "aa", 9), "aa", 0, 0) for i in range(langid.SAMPLE_DOCS + 3000)]
    got = langid.floors(spark.createDataFrame(held, DOC), model)
    scores = [s for lang, s in (model.predict(r[1]) for r in held) if lang == "aa"]
    assert len(scores) > langid.SAMPLE_DOCS and got["aa"] == pytest.approx(langid.MARGIN * np.percentile(scores, 100 * langid.LOW), rel=1e-12)


def test_low_scores_equal_percentiles(spark, monkeypatch):
    rnd = random.Random(12)
    rows = [(lang, rnd.choice([0.0, 0.25, 1.0, rnd.random(), rnd.random()])) for lang, n in (("aa", 1), ("bb", 2), ("cc", 1000), ("dd", 37)) for _ in range(n)]
    scored = spark.createDataFrame(rows, "lang string, score double")
    for bins in (1, 8, 4096):
        monkeypatch.setattr(langid, "BINS", bins)
        for share in (0.0, 0.001, 0.3, 0.5, 1.0):
            got = langid.low_scores(scored, share)
            assert got == pytest.approx({lang: np.percentile([s for was, s in rows if was == lang], 100 * share) for lang in ("aa", "bb", "cc", "dd")})
    assert langid.low_scores(scored.limit(0)) == {}


def test_a_filtered_prediction_is_worked_out_once(spark):
    """A second evaluation takes a second Python worker in every task."""
    rnd = random.Random(12)
    model = langid.fit(spark.createDataFrame(_rows(rnd, 60), DOC))
    rows = _rows(rnd, 40)
    reached = langid.identify(spark.createDataFrame(rows, DOC), model).filter("language.lang_pred = lang").select("doc_id", "language.score")
    assert reached._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {tuple(r) for r in reached.collect()} == {(i, s) for i, t, was, _, _ in rows for lang, s in [model.predict(t)] if lang == was}
