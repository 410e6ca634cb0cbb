"""Main text of web pages by a maximum-scoring subsequence.

A page is read as a sequence of tags and words.  Words score positive and
tags negative; how much depends on the innermost element (for words) and
the tag's name, as log-odds of standing in the content of labelled pages.
Labelled pages are those that mark their content themselves (exactly one
``article`` or ``main`` element); a bounded sample of them is counted by
Spark.  Words in elements marked as boilerplate score negative.  One linear
scan finds the contiguous region of the highest total.  The region's
innermost common element (the enclosing article or main element, where
there is one) is then given out as a whole, so that short paragraphs at
its edges are not lost, without the boilerplate elements inside.

A mark that an element has from a name or as a form is weaker than one
from its kind or role: it does not stand where it covers nearly all words
of the page, and the page's largest article or main element ends the mark
of a wrapper around it.

Text: character references are decoded; white space becomes one blank,
also at the borders of blocks and at line breaks; inline tags join.

Edge cases: null and empty pages, and pages without words, give an empty
text; unclosed and stray tags are tolerated; a table without labelled pages
is scored with the default weights; other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, bounded_sample

SAMPLE_PAGES = 2000
NEARLY = 0.9  # share of the page's words that no name and no form marks as boilerplate
WORD_WEIGHT, TAG_WEIGHT, BOILER_WEIGHT = 0.5, -0.6, -1.5  # of what labelled pages do not show

# Element names of HTML by their part in a page.
RAW = "script style template textarea svg iframe noscript object canvas select title"
BOILER = "nav header footer aside form menu dialog button label"
MAIN = "article main"
INLINE = "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr"
VOID = "area base br col embed hr img input link meta param source track wbr"
AUTO_CLOSED = "p li dt dd option tr td th"
BOILER_NAMES = (
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar comment comments reply replies "
    "respond disqus cookie cookies consent gdpr notice notices alert nav navbar navigation menu breadcrumb breadcrumbs footer header masthead "
    "share sharing social newsletter subscribe subscription signup login related recommended popup modal overlay widget pagination pager toolbar "
    "copyright legal disclaimer"
)
COMMENT_NAMES = "comment comments reply replies ad ads advert advertisement promo sponsored related"  # of an article that is not the page's
NEGATIONS = "has with no without is not"  # "has-sidebar" names a page, not a sidebar
CLASSES_OF = "category tag topic"  # "category-comment" tells what an article is about
BOILER_ROLES = "navigation banner contentinfo complementary search form dialog alert menu menubar toolbar"

_boiler, _main, _inline, _void, _auto, _names, _other, _negated, _about, _roles = (
    frozenset(x.split()) for x in (BOILER, MAIN, INLINE, VOID, AUTO_CLOSED, BOILER_NAMES, COMMENT_NAMES, NEGATIONS, CLASSES_OF, BOILER_ROLES)
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>" + RAW.replace(" ", "|") + r")(?:/>|(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:(?<=[\s\"']/)>|>.*?(?:</(?P=raw)\s*>|\Z)))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^<>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)


def _named(value: str, names: frozenset) -> bool:
    """Whether a class or id attribute has one of the names as a part of a word."""
    for word in value.split():
        parts = [p for p in re.split(r"[^a-z0-9]+", word) if p]
        if parts and parts[0] in _about:
            continue
        for part in parts:
            if part in _negated:
                break
            if part in names:
                return True
    return False


HARD, NAMED, COMMENT = 1, 2, 3  # kinds of marks: by an element's kind, role or hiding; by a name or as a form; by a name of COMMENT_NAMES


def _mark(name: str, attrs: str, by_name: bool) -> int:
    """The mark that an element has of itself, 0 for none."""
    if name in _boiler and name != "form":
        return HARD
    if name in ("html", "body") or not by_name:
        return 0
    mark = NAMED if name == "form" else 0
    names = _other if name in _main else _names
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            return HARD
        if key == "role" and value in _roles:
            return HARD
        if key in ("class", "id") and _named(value, names):
            mark = COMMENT if mark == COMMENT or _named(value, _other) else NAMED
    return mark


class Page:
    """A page's tokens: for each its class, text (None: a tag), element and whether boilerplate encloses it."""

    def __init__(self, source: str | None, by_name: bool = True):
        self._source, self._by_name = source, by_name
        self.kinds: list[str] = []
        self.texts: list[str | None] = []
        self.sizes: list[int] = []
        self.element: list[int] = []
        self.boiler: list[bool] = []
        self.breaks: list[bool] = []
        self.opens: list[bool] = []
        self.parent, self.names = [-1], [""]
        self._own = [0]  # mark of each element
        self._stack = [0]  # of elements
        self._places: dict[str, list[int]] = {}  # name -> its places in the stack
        self._blocks: list[int] = []  # places of elements that are not inline
        self._firm: list[int] = []  # places of those that no inline end tag closes
        source = source or ""
        at = 0
        for m in _TAG.finditer(source):
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if m["name"]:
                self._tag(m["name"].lower(), bool(m["end"]), m["attrs"])
        if at < len(source):
            self._text(source[at:])
        self.last = list(range(len(self.names)))  # the last element inside each: elements stand in page order
        for e in range(len(self.names) - 1, 0, -1):
            self.last[self.parent[e]] = max(self.last[self.parent[e]], self.last[e])
        marks = self._marks()
        for i, e in enumerate(self.element):
            self.boiler[i] = marks[e]
            if marks[e] and (self.texts[i] is not None or self.opens[i]):
                self.kinds[i] = "t:boiler" if self.texts[i] is None else "w:boiler"

    def _marks(self) -> list[bool]:
        """Whether each element is boilerplate, by its own mark or one above it."""
        n = len(self.names)
        hard, words = [False] * n, [0] * n
        for e in range(n):  # parents stand before their children
            hard[e] = self._own[e] == HARD or e > 0 and hard[self.parent[e]]
        for text, e, size in zip(self.texts, self.element, self.sizes):
            if text is not None and not hard[e]:
                words[e] += size
        for e in range(n - 1, 0, -1):
            words[self.parent[e]] += words[e]
        mains = [e for e in range(n) if self.names[e] in _main and not hard[e] and words[e]]
        plain = [e for e in mains if self._own[e] == 0]
        own = list(self._own)
        for e in range(n):
            if own[e] > HARD and words[e] and words[e] >= NEARLY * words[0]:
                if own[e] == NAMED or all(self._holds(e, x) for x in (plain[:1] + plain[-1:])):  # comments beside an article stay, however long
                    own[e] = 0
        marked = [0] * n
        for e in range(n):
            marked[e] = own[e] or (marked[self.parent[e]] if e else 0)
        pick = [e for e in plain if marked[e] != COMMENT] or plain
        ends = max(pick, key=lambda e: words[e], default=None)
        for e in range(n):
            marked[e] = own[e] or (marked[self.parent[e]] if e and e != ends else 0)
        return [hard[e] or marked[e] > 0 for e in range(n)]

    def _add(self, kind: str, text: str | None, size: int, breaks: bool, opens: bool = False) -> None:
        self.kinds.append(kind)
        self.texts.append(text)
        self.sizes.append(size)
        self.element.append(self._stack[-1])
        self.boiler.append(False)
        self.breaks.append(breaks)
        self.opens.append(opens)

    def _text(self, text: str) -> None:
        text = entities.unescape(text)
        size = len(text.split())
        self._add(f"w:{self.names[self._stack[-1]]}", text, size, False)

    def _push(self, name: str) -> None:
        place = len(self._stack)
        self._places.setdefault(name, []).append(place)
        if name not in _inline:
            self._blocks.append(place)
            if name not in _auto:
                self._firm.append(place)
        self.parent.append(self._stack[-1])
        self.names.append(name)
        self._stack.append(len(self.names) - 1)

    def _pop(self, to: int) -> None:
        """Close the elements from the place ``to`` on; each is closed once, so all this is linear in the page."""
        for e in self._stack[to:]:
            self._places[self.names[e]].pop()
        del self._stack[to:]
        for places in (self._blocks, self._firm):
            while places and places[-1] >= to:
                places.pop()

    def _tag(self, name: str, end: bool, attrs: str) -> None:
        breaks = name not in _inline
        kind = f"t:{name}"
        if end:
            self._add(kind, None, 1, breaks)
            places = self._places.get(name)
            if places and (breaks or not self._firm or self._firm[-1] < places[-1]):
                self._pop(places[-1])
            return
        if self._blocks and (name in _auto or breaks and name not in _void):  # a block closes an open paragraph, an item its elder
            top = self.names[self._stack[self._blocks[-1]]]
            if top == name and name in _auto or top == "p":
                self._pop(self._blocks[-1])
        if name not in _void and not attrs.endswith("/"):
            self._push(name)
            self._own.append(_mark(name, attrs, self._by_name))
        self._add(kind, None, 1, breaks, opens=True)

    # -- choosing the content

    def _holds(self, e: int, inner: int) -> bool:
        """Whether an element is another or stands around it."""
        return e <= inner <= self.last[e]

    def _above(self, e: int) -> list[int]:
        line = []
        while e >= 0:
            line.append(e)
            e = self.parent[e]
        return line

    def region(self, weights: dict[str, float]) -> tuple[int, int] | None:
        """First and last token of the best contiguous region."""
        best, total, start, found = 0.0, 0.0, 0, None
        for i, (kind, size) in enumerate(zip(self.kinds, self.sizes)):
            w = weights.get(kind)
            if w is None:
                w = WORD_WEIGHT if kind[0] == "w" else TAG_WEIGHT
                if kind.endswith(":boiler"):
                    w = BOILER_WEIGHT
            total += w * size
            if total <= 0:
                total, start = 0.0, i + 1
            elif total > best:
                best, found = total, (start, i)
        return found

    def content(self, weights: dict[str, float]) -> str:
        text = self._content(weights)
        if not text and self._by_name and any(b and n and t is not None for b, n, t in zip(self.boiler, self.sizes, self.texts)):
            # A name that stands for boilerplate may also be given to the whole page: go by elements alone.
            return Page(self._source, by_name=False)._content(weights)
        return text

    def _content(self, weights: dict[str, float]) -> str:
        found = self.region(weights)
        if not found:
            return ""
        worded = [i for i in range(found[0], found[1] + 1) if self.texts[i] is not None and self.sizes[i] and not self.boiler[i]]
        if not worded:
            return ""
        first, last = min(self.element[i] for i in worded), max(self.element[i] for i in worded)
        line = [e for e in self._above(first) if self._holds(e, last)]
        marked = [e for e in line if self.names[e] in _main]
        whole = marked[-1] if marked else next((e for e in line if self.names[e] in ("div", "td", "body", "html", "")), line[-1])
        inside = [False] * len(self.names)
        inside[whole] = True
        for e in range(whole + 1, len(self.names)):
            inside[e] = inside[self.parent[e]]
        parts = []
        for text, e, boiler, breaks in zip(self.texts, self.element, self.boiler, self.breaks):
            if text is None:
                if breaks:
                    parts.append(" ")
            elif inside[e] and not boiler:
                parts.append(text)
        return " ".join("".join(parts).split())

    def counts(self) -> Counter | None:
        """(class, inside) -> tokens, of a page that marks its content itself; else None."""
        marks = [e for e, n in enumerate(self.names) if n in _main]
        if len(marks) != 1:
            return None
        inside = [False] * len(self.names)
        inside[marks[0]] = True
        for e in range(marks[0] + 1, len(self.names)):
            inside[e] = inside[self.parent[e]]
        seen = Counter()
        for kind, e, size in zip(self.kinds, self.element, self.sizes):
            seen[kind, inside[e]] += size
        return seen


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights of token classes from at most ``sample`` pages that mark their content, in the order of a hash."""
    bounded_batches(pages.sparkSession)
    marked = pages.select("html", F.lit(1).alias("all")).filter(F.lower("html").rlike(r"<(article|main)[\s>]"))
    some = bounded_sample(marked, "all", ["html"], {1: sample})

    def count(batches):
        seen = Counter()
        for b in batches:
            for h in b["html"]:
                seen.update(Page(h).counts() or {})
        yield pd.DataFrame([(k, i, n) for (k, i), n in seen.items()], columns=["kind", "inside", "n"])

    rows = some.repartition(8).mapInPandas(count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    total = {(w, i): 1.0 for w in "wt" for i in (True, False)}
    seen: dict[str, dict[bool, int]] = {}
    for r in rows:
        seen.setdefault(r["kind"], {})[r["inside"]] = r["n"]
        total[r["kind"][0], r["inside"]] += r["n"]
    weights = {}
    for kind, n in seen.items():
        odds = math.log((n.get(True, 0) + 1) / total[kind[0], True]) - math.log((n.get(False, 0) + 1) / total[kind[0], False])
        if kind[0] == "t":
            weights[kind] = min(-0.1, max(-6.0, odds))
        elif kind.endswith(":boiler"):
            weights[kind] = min(-0.1, max(-2.0, odds))
        else:
            weights[kind] = max(0.2, min(1.0, odds))
    return weights


def extract(pages: DataFrame, weights: dict[str, float], out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html``."""
    bounded_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def main_text(sources: pd.Series) -> pd.Series:
        return pd.Series([Page(s).content(weights) for s in sources], dtype=object)

    return pages.withColumn(out, main_text(F.col("html")))
