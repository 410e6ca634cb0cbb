import os
import random

import pytest

import corpus_pipeline as cp
from opsmetrics.llm import decontam, langid, mixing, registry, simhash, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """(input, output) of each stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / "t")
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return [([r.asDict() for r in a.collect()], [r.asDict() for r in b.collect()]) for a, b in out]


def test_columns(steps):
    for rows, kept in steps[:-1]:
        assert list(kept[0]) == list(rows[0]) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_stage(spark, steps):
    model = registry.language_model(spark, SF)
    rows, kept = steps[0]
    keep = lambda t: (p := model.predict(t))[0] != langid.UNKNOWN and p[1] >= cp.LEAST_LANGUAGE
    assert sorted(map(repr, kept)) == sorted(repr(r) for r in rows if keep(r["text"]))
    assert len(kept) >= 0.95 * len(rows)


def test_toxicity_stage(spark, steps):
    model = registry.toxicity_model(spark, SF)
    rows, kept = steps[1]
    score = model.scores(model.tag([r["text"] for r in rows]))
    assert sorted(map(repr, kept)) == sorted(repr(r) for r, s in zip(rows, score) if s < toxicity.THRESHOLD)


def test_near_duplicate_stage(steps):
    rows, kept = steps[2]
    fps = [simhash.fingerprint(r["text"].encode()) for r in rows]
    root = list(range(len(rows)))
    for _ in rows:
        before = list(root)
        for i in range(len(rows)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= cp.DISTANCE:
                    root[i] = root[j] = min(root[i], root[j])
        if root == before:
            break
    groups = {}
    for r, g in zip(rows, root):
        groups.setdefault(g, []).append(r["doc_id"])
    assert sorted(r["doc_id"] for r in kept) == sorted(min(g) for g in groups.values())


def test_benchmark_stage(spark, steps):
    rows, kept = steps[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    was = {r["doc_id"]: r for r in rows}
    hit = {r["doc_id"] for r, found in zip(rows, decontam.brute_force([r["text"] for r in rows], items)) if found[1]}
    assert hit and not any(found[1] for found in decontam.brute_force([r["text"] for r in kept], items))
    for r in kept:
        if r["doc_id"] in hit:
            assert r["n_chars"] == len(r["text"]) < len(was[r["doc_id"]]["text"])
        else:
            assert r == was[r["doc_id"]]
    assert {r["doc_id"] for r in rows} - {r["doc_id"] for r in kept} <= hit


def test_mixing_stage(spark, steps):
    rows, kept = steps[4]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = {r["doc_id"]: (r["size"], r["copies"]) for r in mixing.mix(docs).collect() if r["copies"]}
    assert {r["doc_id"]: (r["mix_size"], r["mix_copies"]) for r in kept} == want


def test_run_gives_the_last_stage(spark, steps):
    got = [r.asDict() for r in cp.run(spark, SF).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, steps[-1][1]))


def test_unlearned_languages_and_random_letters_go(spark):
    rnd = random.Random(6)
    noise = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(150))
    odd = [
        noise,
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza.",
        "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência.",
    ]
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    extra = spark.createDataFrame([(-1 - i, t, "en", "x", len(t)) for i, t in enumerate(odd)], docs.schema)
    kept = [r.doc_id for r in cp.language(spark, docs.unionByName(extra), sf).select("doc_id").collect()]
    assert not [i for i in kept if i < 0]
    assert len(kept) >= 0.995 * n
