import random

from opsmetrics.llm import decontam

DOC = "doc_id long, text string, n_words int, found string"


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], DOC)


def _items(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def _digest(spark, texts, items, **kw):
    docs = _docs(spark, texts).select("doc_id", "text")
    rows = decontam.digest(decontam.scan(docs, _items(spark, items), **kw)).collect()
    return [tuple(r)[1:5] for r in sorted(rows)]


def test_random_texts_match_brute_force(spark):
    rnd = random.Random(3)
    vocab = ["a", "B", "é", "ÉX", "c1", "D"]
    say = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", ", ", "\n", "-", " é "]) for _ in range(n))
    items = [(i, say(rnd.randint(0, 6))) for i in range(12)] + [(3, "B c1 d"), (None, "a a"), (40, None), (41, "")]
    texts = [say(rnd.randint(0, 40)) for _ in range(60)] + [None, "", " .. ", "a", "B"]
    want = decontam.brute_force(texts, items, window=4)
    assert _digest(spark, texts, items, window=4) == want
    assert _digest(spark, texts, items, window=4, part_chars=300) == want  # several automata, each in a pass of its own


def test_empty_tables(spark):
    assert _digest(spark, [], [(1, "a b")]) == []
    assert [r[:3] for r in _digest(spark, ["a b", None], [])] == [(2, 0, 0), (0, 0, 0)]


def test_spans_point_into_the_original_text(spark):
    text = "Ünd so; ONE two—three, four five six seven eight nine ten! end"
    item = "one TWO—three four five six seven eight nine ten end"
    (row,) = decontam.scan(_docs(spark, [text]).drop("found"), _items(spark, [(5, item)]), window=5).collect()
    assert [text[s["start"] : s["stop"]] for s in row["found"]["spans"]] == ["ONE two—three, four five six seven eight nine ten! end"]
    assert row["found"]["items"] == ["5"]


def test_clean_cuts_until_nothing_is_left(spark):
    items = [(1, "p q r s")]
    texts = ["keep p q r s this", "p q p q r s r s tail", "nothing here", None, "p q r s"]
    rows = sorted(decontam.clean(_docs(spark, texts), _items(spark, items), window=4).collect())
    assert [r.text for r in rows] == ["keep\nthis", "\ntail", "nothing here", None, "\n"]
    assert rows[0].found == "x" and rows[0].n_words == 7


def test_clean_in_parts_equals_clean_at_once(spark):
    items = [(1, "p q r s"), (2, "t u v w"), (3, "q q q q"), (None, "x y z z"), (4, "r s t u")]
    texts = ["keep p q r s this", "p q p q r s r s tail", "t u p q r s v w é", "nothing here", None, "", "t u v w t u v w", "x Y, z z!"]
    docs = _docs(spark, texts)
    at_once = sorted(decontam.clean(docs, _items(spark, items), window=4).collect())
    assert decontam._pieces(_items(spark, items), 4, 60)[1] > 2
    in_parts = decontam.clean(docs, _items(spark, items), window=4, part_chars=60)
    assert in_parts.columns == docs.columns and sorted(in_parts.collect()) == at_once


def test_long_items_are_cut_into_pieces_without_losing_a_window(spark):
    words = [f"w{i}" for i in range(decontam.PIECE_WORDS * 3 + 7)]
    pieces, n = decontam._pieces(_items(spark, [(1, " ".join(words)), (2, "Ab-c"), (3, " ,")]), 10, decontam.PART_CHARS)
    found = decontam.patterns([(r.item_id, r["size"], r.text.encode()) for r in pieces.collect()])
    want = {" " + " ".join(words[i : i + 10]) + " ": (10, {"1"}) for i in range(len(words) - 9)} | {" ab c ": (2, {"2"})}
    assert n == 1 and found == want


def test_long_text(spark):
    text = " ".join(f"w{i}" for i in range(60_000))
    got = _digest(spark, [text], [(9, " ".join(f"w{i}" for i in range(59_000, 59_030)))])
    assert got[0][:3] == (60_000, 30, 1)


def test_filtered_scans_are_worked_out_once(spark):
    """A second evaluation takes a second Python worker in every task."""
    docs, items = _docs(spark, ["a b c", "x a b y", None, "z"]), _items(spark, [(1, "a b")])
    runs = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")
    cut = decontam.clean(docs.withColumn("was", docs["text"]), items, window=2).filter("not (text <=> was)")
    assert runs(cut) == 1
    assert sorted((r["doc_id"], r["text"].split()) for r in cut.collect()) == [(0, ["c"]), (1, ["x", "y"])]
    pieces, _ = decontam._pieces(items, 2, 100)
    find = decontam._hits_of(decontam._scanner(pieces, 0))
    hits = docs.select("doc_id", find(docs["text"].cast("binary")).alias("h")).where("size(h.runs) > 0").select("doc_id", "h.*")
    assert runs(hits) == 1
    assert sorted((r["doc_id"], r["items"]) for r in hits.collect()) == [(0, ["1"]), (1, ["1"])]
