import random

import numpy as np
import xxhash

from opsmetrics.llm import simhash
from opsmetrics.llm.components import components

DOC = "doc_id long, text string, fp string, component_id string"


def _plain_fp(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    words = [w for w in words]
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(fps, distance=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def _near(rnd, base, most):
    for b in rnd.sample(range(64), rnd.randint(0, most)):
        base ^= 1 << b
    return base


def test_trie_walk_finds_the_classes_of_all_pairs():
    rnd = random.Random(1)
    seeds = [rnd.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1]
    fps = sorted({_near(rnd, s, 7) for s in seeds for _ in range(40)} | {rnd.getrandbits(64) for _ in range(200)})
    a = np.array(fps, dtype=np.uint64)
    found_a, found_b = [], []
    for turn in (0, 1):
        x, y = simhash.trie_links(np.sort(simhash._rotate(a, turn)), None, 0, 0, 4)
        found_a.append(simhash._rotate(x, turn))
        found_b.append(simhash._rotate(y, turn))
    i, j = np.searchsorted(a, np.concatenate(found_a)), np.searchsorted(a, np.concatenate(found_b))
    got = simhash._forest(len(a), i, j)
    want = _classes(fps)
    assert len(set(zip(got.tolist(), want))) == len(set(got.tolist())) == len(set(want))


def test_spread_walk_with_hot_nodes_cut_into_pieces(spark):
    rnd = random.Random(2)
    hot = rnd.getrandbits(64)
    fps = sorted({_near(rnd, hot, 6) for _ in range(150)} | {_near(rnd, s, 5) for s in [rnd.getrandbits(64) for _ in range(20)] for _ in range(8)})
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5)
    want = _classes(fps)
    for options in ({}, {"node_rows": 16}, {"node_rows": 16, "piece_rows": 25}):
        roots = {r["node"]: r["root"] for r in components(simhash.links(df, **options)).collect()}
        got = [roots.get(x, x) for x in signed]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want)), options


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    long = [[rnd.choice(words) for _ in range(300)] for _ in range(6)]
    texts = [" ".join(w if rnd.random() > 0.01 else "Zz" for w in t) for t in long for _ in range(6)]
    texts += [None, "", " \n", "One two", "one\ttwo", "one two three four", "a b c d e", "a b c d e", "É é"]
    ids = list(range(100, 100 + len(texts)))
    ids[1] = ids[0]
    docs = spark.createDataFrame(list(zip(ids + [None], texts + ["null id"], "x" * 99, "y" * 99)), DOC)
    got = sorted(simhash.near_duplicates(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"]))
    fps = [_plain_fp(t) for t in texts]
    root = _classes(fps)
    want = sorted((i, f"{f:016x}", min(ids[k] for k in range(len(ids)) if root[k] == r)) for i, f, r in zip(ids, fps, root))
    assert [tuple(r) for r in got[:-1]] == want
    assert got[-1]["component_id"] is None


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOC)).collect() == []


def test_long_and_short_texts():
    text = " ".join(f"w{i % 977}" for i in range(50_000))
    assert simhash.fingerprint(text.encode()) == _plain_fp(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n ") == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, x) for x in range(1001, 1200)]
    df = spark.createDataFrame(chain + star + [(5, 5), (3, 2)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(df).collect()}
    assert set(roots) == set(range(1, 61)) | set(range(1000, 1200))
    assert {roots[i] for i in range(1, 61)} == {1} and {roots[i] for i in range(1000, 1200)} == {1000}


def test_keep_one(spark):
    rows = [(2, "a b c d e f", "p", "q"), (1, "a b c d e f", "p", "q"), (1, "a b c d e f", "p", "q"), (1, "a b c d e f", "r", "q"),
            (None, "a b c d e f", "p", "q"), (7, "other words stand here", "p", "q"), (None, None, "p", "q"), (None, None, "p", "q")]
    out = simhash.keep_one(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in out) == [("1", "a b c d e f"), ("7", "other words stand here"), ("None", "None")]
