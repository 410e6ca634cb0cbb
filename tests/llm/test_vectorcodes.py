import random

import numpy as np
import pytest

from opsmetrics.llm import vectorcodes as vc

SCHEMA = "vec_id long, label int, embedding array<float>, code int, error string"


def _plain(rows, parts, entries, rounds):
    """Codes, errors and codebooks by comparing every part with every entry."""
    kept = sorted((r for r in rows if r[2] and all(x is not None and np.isfinite(x) for x in r[2])), key=lambda r: r[0])
    v = [[int(np.floor(256 * float(np.float32(x)))) for x in r[2]] for r in kept]
    w = len(v[0]) // parts
    cut = [[tuple(x[p * w : (p + 1) * w]) for p in range(parts)] for x in v]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for c in cut:
                got.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(x) // len(got[i]) for x in zip(*got[i])) if i in got else e for i, e in enumerate(books[p])]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    return {r[0]: ("".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for r, f in zip(kept, found)}, books


@pytest.mark.parametrize("entries,side", [(64, 4096), (5, 4)])
def test_matches_plain_assignment(spark, monkeypatch, entries, side):
    monkeypatch.setattr(vc, "SIDE_BY_SIDE", side)  # 4: the walk goes down edge by edge
    rnd = random.Random(entries)
    rows = [(i, rnd.choice([None, 1, 2]), [rnd.choice([rnd.gauss(0, 1), 0.25, -0.5]) for _ in range(32)], 0, "x") for i in rnd.sample(range(-500, 5000), 150)]
    rows += [(6000 + i, 1, rows[7][2], 0, "x") for i in range(40)]  # copies
    rows += [(7000, 1, None, 0, "x"), (7001, 1, [None] * 32, 0, "x"), (7002, 1, [float("nan")] * 32, 0, "x"), (-900, 1, [float("inf")] + [0.0] * 31, 0, "x")]
    want, books = _plain(rows, 16, entries, 2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    fitted = vc.fit(df, entries=entries)
    assert fitted.tolist() == [[list(e) for e in b] for b in books]
    got = vc.with_label_error(vc.encode(df, fitted)).collect()
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want and len(got) == 190
    label = {r[0]: r[1] for r in rows}
    for r in got:
        assert r["label_error"] == sum(e for i, (_, e) in want.items() if label[i] == label[r["vec_id"]])


def test_walk_and_decode():
    rng = np.random.default_rng(1)
    parts = rng.integers(-3, 4, (5000, 4))
    rows, place, copies = vc.distinct_parts(parts)
    assert (rows[place] == parts).all() and copies.sum() == 5000 and (np.unique(parts, axis=0) == rows).all()
    book = rng.integers(-3, 4, (9, 4))
    book[5] = book[2]  # a tie goes to the lower index
    nearest, distance = vc.walk(rows, book)
    every = ((rows[:, None, :] - book) ** 2).sum(axis=2)
    assert (nearest == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    wide = np.array([[1 << 29, -(1 << 29), 0], [0, 0, 1]])
    assert (vc.distinct_parts(wide)[0] == wide[::-1]).all()
    assert vc.decode("0102", np.arange(24).reshape(2, 3, 4)).tolist() == [4, 5, 6, 7, 20, 21, 22, 23]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vc.fit(empty) is None and vc.encode(empty, None).count() == 0
    rows = [(None, 1, [1.0] * 16, 0, ""), (5, None, [2.0] * 16, 0, ""), (5, None, [2.0] * 16, 0, ""), (4, 1, [1.0] * 3, 0, ""), (3, 1, [], 0, ""), (6, 1, [3e38] * 16, 0, ""), (7, 1, [2e5] * 16, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    books = vc.fit(df)
    assert books.shape == (16, 4, 1)
    got = vc.with_label_error(vc.encode(df, books)).collect()
    assert sorted((r["vec_id"] or 0, r["error"], r["label_error"]) for r in got) == [(0, 0, 0), (5, 0, 0), (5, 0, 0), (7, 0, 0)]
    assert len({r["code"] for r in got}) == 3
