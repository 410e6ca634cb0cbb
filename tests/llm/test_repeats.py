import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from opsmetrics.llm import bwt, registry, repeats as rp
from opsmetrics.llm.bwt import Transform, merge

DOC = "doc_id long, text string, repeats int, sid string"
SF = "/root/testdata/sf0.001"


def _plain(texts, length):
    """(n_bytes, n_removed, n_spans, sha) by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def _texts(seed, n, length):
    rnd = random.Random(seed)
    say = lambda k: "".join(rnd.choice("abcdé \x00z") for _ in range(k))
    passages = [say(rnd.randint(length - 2, 4 * length)) for _ in range(6)]
    texts = [None, "", "a", "a" * (length - 1), "b" * length, "c" * (length + 1), "ab" * length, "abc" * 3 * length, say(length)]
    for _ in range(n):
        t = [say(rnd.randint(0, 3 * length))]
        for _ in range(rnd.choice([0, 0, 1, 2])):
            t += [rnd.choice(passages), say(rnd.randint(0, length))]
        texts.append("".join(t))
    return texts + [texts[12], texts[13], texts[13]]


def _got(spark, texts, length):
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], DOC).repartition(3)
    rows = rp.digest(rp.dedup(df.drop("repeats"), length)).collect()
    assert len(rows) == len(texts)
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("length", [13, 40, 100])
def test_matches_counting(spark, length):
    texts = _texts(length, 60, length)
    assert _got(spark, texts, length) == _plain(texts, length)


def test_hot_keys_small_buckets_and_segments(spark, monkeypatch):
    """Keys with many distinct pieces are dealt again; buckets, shards, runs and segments all small."""
    for name, value in (("HOT_BYTES", 300), ("BUCKET_BYTES", 400), ("SHARD_BYTES", 100), ("RUN", 5), ("SEGMENT", 64), ("SEEN", 3), ("LEAST_BYTES", 50)):
        monkeypatch.setattr(rp, name, value)
    rnd = random.Random(9)
    say = lambda k: "".join(rnd.choice("abcdefgh") for _ in range(k))
    line, passage = say(14), say(30)  # in a third of the texts: shorter and longer than a window
    texts = [say(rnd.randint(0, 40)) + rnd.choice([line, passage, ""]) + say(rnd.randint(0, 40)) for _ in range(90)] + ["q" * 300, "xyz" * 60]
    assert _got(spark, texts, 20) == _plain(texts, 20)


def test_merge_of_transforms_finds_intervals():
    rnd = random.Random(1)
    for length, step in ((5, 2), (8, 3), (11, 8), (16, 5), (27, 9), (60, 13), (30, 40)):
        strings = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 60))) * rnd.choice([1, 1, 3]) for _ in range(30)]
        cut = [strings[:11], strings[11:12], strings[12:]]
        found = merge([Transform(c, [1] * len(c), length) for c in cut], length, step)
        blocks = {}
        for c, (string, offset, block) in zip(cut, found):
            for s, o, b in zip(string, offset, block):
                blocks.setdefault(int(b), []).append(c[s][o : o + length])
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        want = {w: n for w, n in seen.items() if n > 1}
        assert all(len(set(b)) == 1 for b in blocks.values())
        assert {b[0]: len(b) for b in blocks.values()} == want


def test_transform_is_sorted():
    rnd = random.Random(2)
    strings = [bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randint(0, 50))) for _ in range(20)]
    t = Transform(strings, [1] * 20, 60)
    suffixes = [[b + 1 for b in strings[t.string[p]][t.offset[p] :]] for p in t.order]
    assert suffixes == sorted(suffixes)


def test_rows_in_place_are_not_sorted_again(monkeypatch):
    """A text without repeats has its order after a few bytes, and 40 bytes are named in four sorts of all rows."""
    sizes = []
    plain = bwt._sorted
    monkeypatch.setattr(bwt, "_sorted", lambda key, bits: sizes.append(len(key)) or plain(key, bits))
    text = bytes(np.random.default_rng(4).integers(97, 123, 20_000, dtype=np.uint8))
    t = Transform([text], [2], 200)
    assert sum(sizes) < 2 * len(t.order)
    sizes.clear()
    ((string, offset, _),) = merge([t], 200)
    assert len(string) == 20_000 - 199 and sorted(offset) == [*range(20_000 - 199)]
    assert sizes == [20_001] * 4


def test_small_buckets_in_one_task():
    """Buckets and shards are far smaller than a task's share, so that what a merge sorts stays small."""
    assert 4 * rp.SHARD_BYTES <= rp.BUCKET_BYTES <= rp.TASK_BYTES // 4
    rnd = np.random.default_rng(5)
    say = lambda n: bytes(rnd.integers(97, 123, n, dtype=np.uint8))
    shared = say(300)
    strings = [say(int(n)) + (shared if i % 50 == 0 else b"") for i, n in enumerate(rnd.integers(200, 400, 1500))]
    found = rp.repeated(strings, [1] * len(strings), 200)  # seven shards
    seen = Counter(s[i : i + 200] for s in strings for i in range(len(s) - 199))
    assert [{i for a, n in f for i in range(a, a + n)} for f in found] == [{i for i in range(len(s) - 199) if seen[s[i : i + 200]] > 1} for s in strings]
    assert sum(map(bool, found)) == 30


def test_long_periodic_text(spark):
    texts = ["a" * 3_000_000, "xy" * 1_000_000 + "end", "plain " + "a" * 150]
    got = _got(spark, texts, 200)
    assert [g[1] for g in got] == [3_000_000, 2_000_000, 0]


def test_empty_table(spark):
    assert rp.digest(rp.dedup(spark.createDataFrame([], DOC).drop("repeats"))).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_query_matches_counting(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = sorted(map(tuple, registry.op13_suffix_dedup(spark, SF).collect()))
    want = _plain([r["text"] for r in docs], 200)
    assert got == [(r["doc_id"], *w) for r, w in zip(docs, want)]
    assert sum(w[1] for w in want) > 0
