from collections import defaultdict

from opsmetrics.llm.common import bounded_sample


def test_sample_keeps_the_limits_and_repeats_itself(spark):
    rows = [(i, "ab"[i % 10 == 0]) for i in range(5000)] + [(None, "c"), (None, "c"), (7, "c")]
    df = spark.createDataFrame(rows, "id long, kind string")
    limits = defaultdict(lambda: 300, c=2)
    first = bounded_sample(df.repartition(3), "kind", ["id"], limits).collect()
    again = bounded_sample(df.repartition(7), "kind", ["id"], limits).collect()
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)
    count = {k: sum(r["kind"] == k for r in first) for k in "abc"}
    assert count == {"a": 300, "b": 300, "c": 2}
    assert sorted(r["nth"] for r in first if r["kind"] == "a") == list(range(1, 301))


def test_a_sample_smaller_than_its_limit_is_whole(spark):
    df = spark.createDataFrame([(i, "x") for i in range(50)], "id long, kind string")
    assert bounded_sample(df, "kind", ["id"], {"x": 50}).count() == 50
    assert bounded_sample(df.filter("false"), "kind", ["id"], {}).count() == 0
