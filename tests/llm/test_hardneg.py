import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsmetrics.llm import hardneg as hn

SCHEMA = "vec_id long, label int, embedding array<float>, rank int, row string"


def _plain(rows, every, low=80, high=100):
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and len(v) == 12
    kept = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v, *_ in rows if i is not None and lab is not None and ok(v)]
    out = []
    for n, (a, lab, v) in enumerate(kept):
        if a % every:
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w))  # noqa: E731, B023
        others = [(-score(w), i, lb) for m, (i, lb, w) in enumerate(kept) if m != n]
        for p, pid, _ in sorted(x for x in others if x[2] == lab)[:5]:
            fits = sorted(x for x in others if x[2] != lab and low * -p <= 100 * -x[0] <= high * -p)[:5]
            out += [(a, pid, k, i, -p, -s) for k, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def _rows(seed, n):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres)
        v = [x + rnd.gauss(0, rnd.choice([0.1, 0.5])) for x in c] if rnd.random() < 0.8 else [rnd.choice([-1.0, 0.0, 0.5]) for _ in range(12)]
        rows.append((i, rnd.choice([1, 1, 1, 2, 3]), v, 0, ""))
    return rows


@pytest.mark.parametrize("shard_rows,look", [(10**6, 512), (60, 3)])
def test_matches_brute_force(spark, monkeypatch, shard_rows, look):
    monkeypatch.setattr(hn, "LOOK", look)
    monkeypatch.setattr(hn, "CELL_ROWS", 4)
    rows = _rows(look, 400)
    rows += [(1000 + i, 2, rows[3][2], 0, "") for i in range(30)]  # equal vectors: ties go to the smaller id
    rows += [(2000, None, rows[1][2], 0, ""), (2010, 1, None, 0, ""), (2020, 1, [None] * 12, 0, ""), (2030, 1, [float("inf")] * 12, 0, ""), (None, 1, rows[1][2], 0, ""), (2040, 1, [1.0], 0, "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = hn.mine(df, F.col("vec_id") % 10 == 0, shard_rows=shard_rows).collect()
    assert sorted(map(tuple, got)) == _plain(rows, 10)
    other = hn.mine(df, F.col("vec_id") % 50 == 0, low=50, high=90, shard_rows=shard_rows).collect()
    assert sorted(map(tuple, other)) == _plain(rows, 50, 50, 90)


def test_uneven_lengths_and_wide_integers(spark):
    rows = _rows(5, 150)
    rows = [(i, lab, [x * (3000.0 if i % 40 == 0 else 1.0) for x in v], 0, "") for i, lab, v, *_ in rows]
    rows += [(200 + i, 1 + i % 2, [x * 4e5 for x in v], 0, "") for i, (_, _, v, *_) in enumerate(rows[1:20])]  # beyond what doubles hold exactly
    df = spark.createDataFrame(rows, SCHEMA)
    got = hn.mine(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == _plain(rows, 10)


def test_cells_are_visited_by_falling_bounds():
    rng = np.random.default_rng(4)
    v = rng.integers(-50, 50, (500, 8))
    books = [hn._means(v[:, :4], 5), hn._means(v[:, 4:], 5)]
    codes = np.column_stack([hn._nearest(v[:, :4], books[0]), hn._nearest(v[:, 4:], books[1])])
    cells = hn.Cells(v, np.arange(500), np.ones(500, dtype=int), np.arange(500), codes, books)
    seen, last = [], math.inf
    for places, left in cells.visit(v[0]):
        assert cells.scores(v[0], places).max() <= last
        seen += places.tolist()
        last = left
    assert sorted(seen) == list(range(500))


def test_odd_tables(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(100, 1, [1.0, 2.0, 3.0], 0, "")], SCHEMA)
    assert hn.mine(one, F.col("vec_id") % 100 == 0).count() == 0
    twice = spark.createDataFrame([(100, 1, [1.0, 0.0, 3.0], 0, "")] * 2 + [(7, 2, [0.9, 0.0, 3.0], 0, "")], SCHEMA)
    assert [tuple(r)[:4] for r in hn.mine(twice, F.col("vec_id") % 100 == 0).collect()] == [(100, 100, 1, 7)] * 2
