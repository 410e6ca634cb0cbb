import random

import numpy as np
import pytest

from opsmetrics.llm import urlfilter as uf

PAGE = "page_id long, url string, host int, rule int, verdict int"


def _plain(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?", 1)[0].split("#", 1)[0]
    best = None
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        p = "/" + p if "/" in rule else ""
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(rule), len(h), rule, verdict))
    return host, path, best and best[2], best[3] if best else default


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/x", "http://example.org/en/12?q#f", "http://a.b.example.org/en/2", "x://com", "x://com/fr/",
        "http://badcom/de/", "http://x.com/de/?a://b", "http://x.com?/de/", "http://x.com#/fr/", "a://b://c/d", "http://example.org/es", "https://É.org/É/", "http://.org/",
        "http://a..org//", "http://x.com/de/" + "y" * 3000, "line://a.org/\nb"]


@pytest.mark.parametrize("max_bytes", [uf.MAX_BYTES, 0])
def test_fixed_urls(spark, max_bytes):
    docs = spark.createDataFrame([(i, u, 1, 2, 3) for i, u in enumerate(URLS + URLS)], PAGE).select("page_id", "url")
    rows = sorted(uf.judge(docs, uf.rule_table(spark, uf.RULES), max_bytes=max_bytes).collect())
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [_plain(u, uf.RULES) for u in URLS + URLS]


@pytest.mark.parametrize("max_bytes", [uf.MAX_BYTES, 0])
def test_random_rules(spark, max_bytes):
    rnd = random.Random(8)
    host = lambda: ".".join(rnd.choice(["a", "b", "cc"]) for _ in range(rnd.randint(1, 4)))
    path = lambda: "".join(rnd.choice(["/", "x", "y/"]) for _ in range(rnd.randint(0, 4)))
    rules = [(rnd.choice(["allow", "block"]), host() + rnd.choice(["", "/" + path()])) for _ in range(150)]
    rules += [("block", r) for _, r in rules[:10]] + [("allow", r) for _, r in rules[:10]]
    urls = [f"http://{host()}/{path()}" for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = sorted(uf.judge(docs, uf.rule_table(spark, rules), max_bytes=max_bytes).collect())
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [_plain(u, rules) for u in urls]


def test_empty_pages_and_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(none, uf.rule_table(spark, uf.RULES)).collect() == []
    some = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    (row,) = uf.judge(some, spark.createDataFrame([], "key string, verdict string")).collect()
    assert (row.rule, row.verdict) == (None, "allow")


def test_cascade_is_exact_over_its_universe(spark):
    keys = [f"k{i}" for i in range(3000)]
    df = lambda x: spark.createDataFrame([(k,) for k in x], "key string")
    listed = keys[::7] + ["not in the universe"]
    cascade = uf.cascade(df(listed), df(keys))
    assert len(cascade.levels) > 1
    assert cascade.holds(uf.hashed(keys)).tolist() == [k in set(listed) for k in keys]
    assert not uf.cascade(df([]), df(keys)).holds(uf.hashed(keys)).any()
    assert uf.cascade(df(keys), df(keys)).holds(uf.hashed(keys)).all()
    assert np.all(uf.cascade(df(keys), df([])).holds(uf.hashed(keys)))
