import numpy as np
import pandas as pd

from opsmetrics.llm import ann

VEC = "vec_id long, embedding array<float>, label int, rank string, score string"


def _df(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], VEC)


def _exact(rows, every, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    out = {}
    for i, v in zip(ids, x):
        if i % every == 0:
            score = (x * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def _got(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 24)) * 0.5
    rows = [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(x)]
    got, want = _got(ann.nearest(_df(spark, rows), shard_rows=900)), _exact(rows, 20, 20)
    assert got.keys() == want.keys()
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found >= 0.95 * 20 * len(want)
    exact = {(q, i): s for q in want for i, s in want[q]}
    for q, pairs in got.items():
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))
        assert all(abs(exact[q, i] - s) < 1e-9 for i, s in pairs if (q, i) in exact)


def test_recall_on_uneven_gaussian_and_huge_vectors():
    """One shard each, without Spark: lengths of all sizes, no clusters at all, components near the end of single precision."""
    rng = np.random.default_rng(5)
    plain = rng.normal(size=(3000, 32))
    uneven = plain * np.exp(rng.normal(size=(3000, 1)))
    one_long = plain.copy()
    one_long[7] *= 3000
    centres = rng.normal(size=(12, 32))
    clustered = centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 32)) * 0.3
    for name, x in {"plain": plain, "uneven": uneven, "one long": one_long, "clustered": clustered, "huge": one_long * 1e34}.items():
        x = x.astype(np.float32).astype(float)
        group = pd.DataFrame({"shard": 0, "vec_id": np.arange(len(x)), "v": list(x)})
        row = ann._indexed(group).iloc[0].to_dict()
        row |= {"q_ids": np.arange(0, 3000, 20).tobytes(), "q_vectors": x[::20].tobytes()}
        found = 0
        for query, ids, scores in ann._best(row, 20):
            score = x @ x[query]
            want = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != query][:20]
            found += len({*ids} & {*map(int, want)})
            assert np.allclose(scores, score[ids], rtol=1e-12)
        assert found >= 0.95 * 150 * 20, (name, found / 3000)


def test_a_vector_shared_by_many_rows(spark):
    rng = np.random.default_rng(2)
    hot = [3.0] * 8
    rows = [(i, hot) for i in range(500)] + [(i, [float(c) for c in rng.normal(size=8).astype(np.float32)]) for i in range(500, 700)]
    got, want = _got(ann.nearest(_df(spark, rows), shard_rows=200)), _exact(rows, 20, 20)
    assert [i for i, _ in got[0]] == list(range(1, 21)) and [i for i, _ in got[20]] == [*range(20)]
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.95 * 20 * len(want)


def test_few_rows_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (None, [1.0, 1.0]), (7, []), (40, [1.0, 2.0, 3.0]), (8, [-1.0, 0.0]), (1, [1.0, 1.0]), (8, [5.0, 0.0])]
    got = _got(ann.nearest(_df(spark, rows)))
    assert got == {0: [(1, 1.0), (20, 0.0), (8, -1.0)], 20: [(1, 2.0), (0, 0.0), (8, 0.0)]}
    assert ann.nearest(_df(spark, [])).collect() == []


def test_every_node_is_reached():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40, 700):
        x = np.unique(np.round(rng.normal(size=(n, 6)) * (1 + 50 * (rng.random((n, 1)) < 0.1)), 2), axis=0)
        graph, entry = ann.build(x)
        seen, todo = {entry}, [entry]
        while todo:
            for j in graph[todo.pop()]:
                if j >= 0 and int(j) not in seen:
                    seen.add(int(j))
                    todo.append(int(j))
        assert len(seen) == len(x)


def test_a_search_scores_a_node_once_and_ranks_all(monkeypatch):
    """A beam as wide as the graph ranks every node; no query scores a node twice, and half of the expansions share a sort."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 8))
    graph, entry = ann.build(x)
    scored = []
    plain = ann._keys
    monkeypatch.setattr(ann, "_keys", lambda near, ids: scored.append(len(ids)) or plain(near, ids))
    points, queries = ann.scaled(x).astype(np.float32), rng.normal(size=(40, 8)).astype(np.float32)
    found = ann.beam_search(points, graph, entry, queries, 600)
    assert (np.sort(found, axis=1) == np.arange(600)).all()
    near = np.take_along_axis(queries @ points.T, found, axis=1)
    assert (np.diff(near, axis=1) <= 1e-6).all()
    assert sum(scored) == 40 * 600 and len(scored) <= 300
    few = ann.beam_search(points, graph, entry, queries, 1000)
    assert (few[:, 600:] == -1).all() and (few[:, :600] == found).all()


def test_recall_where_many_shards_have_narrower_beams():
    """Vectors without clusters in six shards: each is searched for its share of the neighbours only."""
    beams = [ann.search_beam(n, 20) for n in (1, 2, 6, 1000)]
    assert beams[0] == ann.SEARCH_BEAM and beams == sorted(beams, reverse=True) and beams[-1] == ann.LEAST_BEAM
    assert ann.search_beam(1000, 500) == 1000
    rng = np.random.default_rng(9)
    x = rng.normal(size=(6000, 32)).astype(np.float32).astype(float)
    best = {}
    for shard in range(6):
        ids = np.arange(shard, 6000, 6)
        row = ann._indexed(pd.DataFrame({"shard": shard, "vec_id": ids, "v": list(x[ids])})).iloc[0].to_dict()
        row |= {"q_ids": np.arange(0, 6000, 60).tobytes(), "q_vectors": x[::60].tobytes()}
        for query, who, scores in ann._best(row, 20, 6):
            best.setdefault(query, []).extend(zip(scores, who))
    found = 0
    for query, pairs in best.items():
        want = [i for i in np.lexsort((np.arange(6000), -(x @ x[query]))) if i != query][:20]
        found += len({i for _, i in sorted(pairs, reverse=True)[:20]} & {*map(int, want)})
    assert found >= 0.97 * 100 * 20, found / 2000
