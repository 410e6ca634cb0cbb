import random

from opsmetrics.llm import mixing

DOC = "doc_id long, text string, lang string, source string, n_chars long, size int, taken int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", s, 0, 1, 1) for i, t, s in rows], DOC)


def _mix(spark, rows, **kw):
    return mixing.mix(_docs(spark, rows), **kw).collect()


def _fair(rows, weights=(1, 2, 3)):
    """Targets by repeated sharing."""
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(size.values())
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 3 * size[s]}
        if not over:
            return target | share, size
        for s in over:
            target[s] = 3.0 * size[s]
            left -= 3 * size[s]
        free -= over
    return target, size


def _check(spark, rows, **kw):
    got = _mix(spark, rows, **kw)
    assert len(got) == len(rows)
    target, size = _fair(rows)
    taken = {s: 0 for s in size}
    longest = {s: 0 for s in size}
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert abs(r["target"] - target[r["source"]]) <= 1e-6 * max(1, target[r["source"]])
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    assert sum(taken.values()) <= sum(size.values())
    bound = 2 * max(longest.values(), default=0)
    assert all(abs(taken[s] - target[s]) <= bound for s in size), (taken, target)
    return got


def test_random_sources_reach_their_targets(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.choice([0, 1, 5, 9, 30]), rnd.choice(["a", "a", "a", "b", "Ç", "zz", None, ""])) for i in range(900)]
    first = _check(spark, rows)
    again = _check(spark, list(reversed(rows)))
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)


def test_coarse_grid_and_no_prefix_agree(spark):
    rnd = random.Random(6)
    rows = [(i, "w " * rnd.randint(0, 12), rnd.choice("abc")) for i in range(300)]
    plain = sorted(map(tuple, _mix(spark, rows)))
    assert plain == sorted(map(tuple, _mix(spark, rows, grid=2, prefix=1)))


def test_edge_cases(spark):
    assert _mix(spark, []) == []
    rows = _mix(spark, [(1, None, "a"), (None, " ", None), (2, "", "b")])
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 3
    # Repeated rows share their fate; null ids and ties do no harm.
    rows = [(1, "x y", "a")] * 40 + [(None, "x", "b")] * 9 + [(None, "x", None)]
    got = _mix(spark, rows)
    assert len({(r["source"], r["taken"]) for r in got}) == len({r["source"] for r in got})


def test_one_source_takes_itself_once(spark):
    got = _mix(spark, [(i, "w " * (i % 7), "only") for i in range(50)])
    assert all(r["taken"] == r["size"] for r in got)


def test_mixed_documents_keep_texts_and_columns(spark):
    rows = [(i, f"t{i} " * (1 + i % 5), "ab"[i % 3 == 0]) for i in range(120)]
    docs = _docs(spark, rows)
    plan = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs).collect()
    assert {r["doc_id"] for r in out} == {d for d, r in plan.items() if r["copies"]}
    assert all(r["mix_copies"] == plan[r["doc_id"]]["copies"] and r["text"] == rows[r["doc_id"]][1] for r in out)
    assert set(docs.columns) <= set(out[0].asDict())
