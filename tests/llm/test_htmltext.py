from opsmetrics.llm import htmltext as ht

PAGE = "page_id long, html string, text int"
HEAD = "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>Home</a><li><a>More</a></ul></nav>"
FOOT = "<footer>&copy; site</footer></body></html>"


def _texts(spark, pages, weights=None):
    df = spark.createDataFrame([(i, h, 0) for i, h in enumerate(pages)], PAGE)
    weights = ht.fit(df) if weights is None else weights
    return [r.text for r in sorted(ht.extract(df.drop("text"), weights).collect())]


def test_article_pages(spark):
    body = "<article><h1>Big &amp; <i>bold</i></h1><p><b>One  two\nthree.<br><p>Four five&nbsp;six.</p><form><p>Mail</p></form><aside>See also</aside><p>Of.</p></article>"
    page = HEAD + "<!-- ad --><div class='ad'>Buy this now</div>" + body + "<section id=comments><p>I like it very much indeed</p></section>" + FOOT
    assert _texts(spark, [page] * 3) == ["Big & bold One two three. Four five six. Of."] * 3


def test_pages_without_marked_content(spark):
    words = " ".join(["word"] * 80)
    marked = HEAD + f"<article><p>{words}</p></article>" + FOOT
    plain = HEAD + f"<div class=content><h2>Head</h2><p>{words}</p><p>End.</p></div><div class='side-bar sidebar'><p>Other</p></div>" + FOOT
    assert _texts(spark, [marked, plain])[1] == f"Head {words} End."
    assert _texts(spark, [plain], {})[0] == f"Head {words} End."


def test_odd_pages(spark):
    pages = [None, "", "   ", "<p>", "just words", "<<<>>> <a href='x", "a < b and c > d", "<div " + "x" * 50_000, "<p>" * 3000 + "deep", "&#x41;&bogus;&lt;b&gt;", "<!-- never closed <p>x</p>",
             "</p></div><article>only this</article></body>", "<script>never closed", HEAD + FOOT]
    got = _texts(spark, pages, {})
    assert got[:3] == ["", "", ""] and got[4] == "just words" and got[6] == "a < b and c > d" and got[9] == "A&bogus;<b>"
    assert got[10] == "" and got[11] == "only this" and got[12] == "" and got[13] == ""


def test_long_page_and_empty_table(spark):
    words = " ".join(f"w{i}" for i in range(50_000))
    assert _texts(spark, [HEAD + f"<article><p>{words}</p></article>" + FOOT]) == [words]
    assert _texts(spark, []) == []


def test_region_is_the_best_of_all():
    import random

    rnd = random.Random(5)
    weights = {"w:p": 0.7, "t:p": -2.0, "t:div": -3.5}
    for _ in range(50):
        page = ht.Page("".join(rnd.choice(["<p>", "</p>", "<div>", "</div>", "x y ", "z "]) for _ in range(30)))
        value = [weights.get(k, ht.WORD_WEIGHT if k[0] == "w" else ht.TAG_WEIGHT) * n for k, n in zip(page.kinds, page.sizes)]
        best = max(((sum(value[i : j + 1]), i, j) for i in range(len(value)) for j in range(i, len(value))), default=(0,))
        found = page.region(weights)
        got = sum(value[found[0] : found[1] + 1]) if found else 0.0
        assert abs(got - max(0.0, best[0])) < 1e-9


def test_names_that_are_not_boilerplate(spark):
    words = " ".join(["word"] * 60)
    article = f"<article><h1>T</h1><p>{words}</p></article>"
    comments = "<article class=comment><p>me too and more words than one</p></article>" * 3
    pages = [f"<body class='x'><div class='page has-sidebar no-ads'>{article}{comments}</div></body>", f"<div class='header'>{article}</div>",
             f"<main>{article}<div id=comment-list><p>{words}</p></div></main>"]
    assert _texts(spark, pages, {}) == [f"T {words}"] * 3


def test_names_and_forms_do_not_take_the_article(spark):
    words = " ".join(["word"] * 60)
    skip, article = "<a href=#c>Skip to content</a>", f"<article><h1>T</h1><p>{words}</p></article>"
    side, talk = "<div class=sidebar><p>Other text beside</p></div>", "<section><p>" + "some more talk " * 15 + "</p></section>"
    pages = [
        f"<body>{skip}<div class='content-sidebar-wrap'>{article}{side}</div>{talk}</body>",
        f"<body>{skip}<div class='content-sidebar-wrap'><div class=post><h1>T</h1><p>{words}</p></div>{side}</div></body>",
        f"<body>{skip}<article class='post category-comment'><h1>T</h1><p>{words}</p></article></body>",
        f"<body><form action=x><nav>Home</nav>{article}{side}</form></body>",
        f"<body><div class='page-has-sidebar'>{article}{side}</div></body>",
    ]
    got = _texts(spark, pages, {"t:section": -30.0})
    assert got == [f"T {words}"] * 5


def test_comments_and_small_forms_stay_out(spark):
    words = " ".join(["word"] * 60)
    talk = "<div id=comments><article><p>" + "a very long comment " * 200 + "</p></article></div>"
    form = "<form><p>Give your mail here</p></form>"
    page = f"<body><article><h1>T</h1><p>{words}</p>{form}</article>{talk}</body>"
    teaser = f"<body><article><h1>T</h1><p>{words}</p></article><div class=sidebar><article><p>A teaser text</p></article></div></body>"
    assert _texts(spark, [page, teaser], {}) == [f"T {words}"] * 2


def test_self_closed_raw_tags_end_at_once(spark):
    words = " ".join(["word"] * 30)
    pages = [f"<body>{tag}<article><p>{words}</p></article></body>" for tag in ("<svg/>", '<object data="x"/>', "<svg class='a' />")]
    pages += [f"<body><iframe src=http://a/>fallback</iframe><svg><title>No</title></svg><article><p>{words}</p></article></body>"]
    assert _texts(spark, pages, {}) == [words] * 4


def test_deep_nesting_is_read_in_linear_time():
    import time

    for tag in ("<div>", "<p><b>", "<i>", "<b><div></b>", "<div class=ad>a "):
        began = time.time()
        page = ht.Page(tag * 200_000 + "<article><p>two words</p></article>")
        assert page.content({}).endswith("two words")
        assert time.time() - began < 60  # seconds; twelve minutes when each end tag read the whole stack


def test_common_element_of_the_region_equals_the_ancestors_in_common():
    import random

    rnd = random.Random(4)
    for _ in range(300):
        names = "div p b li ul td section article h1".split()
        page = ht.Page("".join(rnd.choice([f"<{rnd.choice(names)}>", f"</{rnd.choice(names)}>", "word "]) for _ in range(rnd.randint(1, 80))))
        n = len(page.names)
        above = [set(page._above(e)) for e in range(n)]
        assert all(page._holds(a, b) == (a in above[b]) for a in range(n) for b in range(n))
