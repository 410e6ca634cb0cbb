"""Language identification by language-bitmask n-gram filters.

Training: character n-grams (inside words, a word's ends count as a
character) of labelled texts are counted by language.  An n-gram belongs
to the languages whose rate of it is at least ``RATIO`` of the highest
rate.  A bit-sliced Bloom filter holds them: each of its cells is a mask
with one bit for each language; an n-gram sets its languages' bits in
``HASHES`` cells, and the AND of these cells returns all its languages at
once.  The filter's size follows the training sample: at most
``SAMPLE_DOCS`` labelled documents of each language, in the order of a
hash, so it is bounded and sent to every task.

Prediction: over all n-grams of the whole text, each language's count of
set bits is freed of the share that its false positives make (rate f =
fill of its slice to the power of ``HASHES``): (count - n f) / (1 - f).
The highest count decides, ties go to the smaller name; the score is that
count's share of all n-grams.

Floors: all labelled texts that are held out are scored; a language's floor
is ``MARGIN`` of the score that all but ``LOW`` of its texts reach.  The
scores are stored and counted by bins; only those up to the bin where the
wanted rank lies are ranked, so no task ranks a language's texts whole.  Texts of a language
that was not learned, and random letters, stay below it.  A language
without such texts has the lowest floor of the others.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
without any labelled text all are ``und``; letters whose n-grams are all
unknown give the first language with score 0; null labels are not learned
from; labels may be any text, one bit each, in masks of 64.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, bounded_sample, evaluated_once, store

SAMPLE_DOCS = 3000  # labelled documents of each language that are learned from, at most
ORDERS = (2, 3, 4)
HASHES = 2
CELLS = 12  # of the filter, for each n-gram
RATIO = 0.4
LEAST = 3  # times an n-gram must occur in a language
LOW = 0.001  # share of a language's held-out texts that its floor does not look at
MARGIN = 0.8  # of the score that the others reach, so that clean texts stay
UNKNOWN = "und"
BINS = 4096  # of the scores, when a rank among them is looked for
PIECE = 1 << 20  # characters handled at once


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def _points(text: str) -> np.ndarray:
    """Code points of the lower-cased text, one 0 for each run of other characters and at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.zeros(len(points) + 2, dtype=np.uint32)
    out[1:-1] = np.where(_letters()[points], points, 0)
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def grams(text: str | None) -> np.ndarray:
    """64-bit hashes of all n-grams of a text, each at its start once; ``PIECE`` starts are worked out at a time."""
    points, found = _points(text or ""), []
    if not text:
        return np.zeros(0, dtype=np.uint64)
    for n in ORDERS:
        for first in range(0, len(points) - n + 1, PIECE):
            p = points[first : first + PIECE + n - 1].astype(np.uint64)
            size = len(p) - n + 1
            h = np.full(size, n, dtype=np.uint64)
            inner = np.ones(size, dtype=bool)
            for k in range(n):
                c = p[k : k + size]
                h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                if 0 < k < n - 1:
                    inner &= c != 0
            found.append(h[inner] if n > 2 else h)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


class Filter:
    """Bit-sliced Bloom filter: cells of language masks, ``words`` numbers of 64 bits each."""

    def __init__(self, langs: list[str], cells: int, masks: np.ndarray | None = None):
        self.langs, self.cells = langs, cells
        width = -(-max(1, len(langs)) // 64)
        kind = np.uint8 if len(langs) <= 8 else np.uint64
        self.masks = np.zeros((width, cells), dtype=kind) if masks is None else masks

    def _spots(self, h: np.ndarray):
        step = (h >> np.uint64(32)) | np.uint64(1)
        for k in range(HASHES):
            with np.errstate(over="ignore"):
                yield ((h + np.uint64(k) * step) % np.uint64(self.cells)).astype(np.int64)

    def add(self, h: np.ndarray, lang: int) -> None:
        for at in self._spots(h):
            self.masks[lang // 64][at] |= self.masks.dtype.type(1 << (lang % 64))

    def rates(self) -> np.ndarray:
        """Each language's false positive rate."""
        one = self.masks.dtype.type(1)
        fill = [float(((self.masks[i // 64] >> self.masks.dtype.type(i % 64)) & one).mean()) for i in range(len(self.langs))]
        return np.minimum(np.array(fill) ** HASHES, 0.999)

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Corrected count of each language."""
        rows = None
        for at in self._spots(h):
            cell = self.masks[:, at]
            rows = cell if rows is None else rows & cell
        one = self.masks.dtype.type(1)
        if self.masks.dtype == np.uint8:  # one histogram of the masks tells all counts
            seen = np.bincount(rows[0], minlength=256)
            counts = np.array([seen[(np.arange(256) >> i) & 1 == 1].sum() for i in range(len(self.langs))], dtype=float)
        else:
            counts = np.array([float(((rows[i // 64] >> np.uint64(i % 64)) & one).sum()) for i in range(len(self.langs))])
        return (counts - len(h) * self._rate) / (1 - self._rate)

    @functools.cached_property
    def _rate(self) -> np.ndarray:
        return self.rates()

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        h = grams(text)
        counts = self.counts(h)
        best = int(np.argmax(counts))  # the first of equals: languages are sorted
        return self.langs[best], float(min(1.0, max(0.0, counts[best] / max(1, len(h)))))


def fit(labelled: DataFrame, sample: int = SAMPLE_DOCS) -> Filter:
    """Filter from rows of (doc_id, text, lang); at most ``sample`` documents of each language."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    rows = bounded_sample(rows, "lang", ["doc_id", "text"], defaultdict(lambda: sample)).select("text", "lang")

    def count(batches):
        """n-grams of each language, summed over the task."""
        sums: dict[str, list] = {}
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                for i in range(0, len(texts), 200):
                    h, n = np.unique(np.concatenate([grams(t) for t in texts[i : i + 200]]), return_counts=True)
                    sums.setdefault(lang, []).append((h, n))
        for lang, parts in sums.items():
            h, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pd.DataFrame({"lang": lang, "gram": h.view(np.int64), "n": n})

    counts = rows.repartition("lang", F.pmod(F.xxhash64("text"), F.lit(16))).mapInPandas(count, "lang string, gram long, n long")
    counts = store(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Filter([], 64)
    rate = F.col("n") / F.element_at(F.create_map(*[x for k, v in totals.items() for x in (F.lit(k), F.lit(float(v)))]), F.col("lang"))
    rated = counts.withColumn("rate", rate)
    top = F.max("rate").over(W.partitionBy("gram"))
    chosen = rated.withColumn("top", top).filter((F.col("rate") >= RATIO * F.col("top")) & (F.col("n") >= LEAST))
    chosen = store(chosen.select("lang", "gram"), "langid-chosen")
    cells = max(64, CELLS * chosen.select("gram").distinct().count())

    def fill(batches):
        part = Filter(langs, cells)
        for b in batches:
            for lang, hs in b.groupby("lang")["gram"]:
                part.add(hs.to_numpy().view(np.uint64), langs.index(lang))
        for w in range(len(part.masks)):
            at = np.flatnonzero(part.masks[w])
            # Cells go out in blocks: a short table for the OR below.
            for block, hit in pd.Series(at).groupby(at >> 12):
                dense = np.zeros(4096, dtype=part.masks.dtype)
                dense[hit.to_numpy() & 4095] = part.masks[w][hit.to_numpy()]
                yield pd.DataFrame({"w": [w], "block": [block], "bits": [dense.tobytes()]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        kind = Filter(langs, 64).masks.dtype
        dense = np.bitwise_or.reduce([np.frombuffer(b, dtype=kind) for b in group["bits"]])
        return pd.DataFrame({"w": [group["w"].iloc[0]], "block": [group["block"].iloc[0]], "bits": [dense.tobytes()]})

    kind = "w int, block long, bits binary"
    blocks = chosen.coalesce(4).mapInPandas(fill, kind).groupBy("w", "block").applyInPandas(merge, kind).collect()
    made = Filter(langs, cells)
    for r in blocks:
        dense = np.frombuffer(r["bits"], dtype=made.masks.dtype)
        at = r["block"] * 4096
        made.masks[r["w"]][at : at + 4096] = dense[: max(0, min(4096, cells - at))]
    return made


def predicted(text: Column, model: Filter, spark) -> Column:
    """Struct (lang_pred, score) of a text column."""
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([held.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return evaluated_once(predict)(text)


def identify(docs: DataFrame, model: Filter, out: str = "language") -> DataFrame:
    """``docs`` with the struct column ``out``: lang_pred, score."""
    return docs.withColumn(out, predicted(F.col("text"), model, docs.sparkSession))


def low_scores(scored: DataFrame, share: float = LOW) -> dict[str, float]:
    """Of rows (lang, score from 0 to 1) each language's ``percentile(score, share)``, interpolated between its two nearest ranks."""
    bin_of = F.floor(F.col("score") * BINS).cast("int")
    bins: dict[str, list] = {}
    for r in scored.groupBy("lang", bin_of.alias("bin")).count().collect():
        bins.setdefault(r["lang"], []).append((r["bin"], r["count"]))
    at = {lang: (sum(n for _, n in counts) - 1) * share for lang, counts in bins.items()}
    cut = {}
    for lang, counts in bins.items():
        before = 0
        for b, n in sorted(counts):
            cut[lang], before = b, before + n
            if before > math.ceil(at[lang]):
                break
    if not cut:
        return {}
    last = F.create_map(*[x for lang, b in cut.items() for x in (F.lit(lang), F.lit(b))])
    low = scored.filter(bin_of <= F.element_at(last, F.col("lang")))
    low = low.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("score")) - 1)
    wanted = F.create_map(*[x for lang, p in at.items() for x in (F.lit(lang), F.array(F.lit(math.floor(p)), F.lit(math.ceil(p))))])
    ranked = {(r["lang"], r["rank"]): r["score"] for r in low.filter(F.array_contains(F.element_at(wanted, F.col("lang")), F.col("rank"))).collect()}
    out = {}
    for lang, p in at.items():
        a, b = math.floor(p), math.ceil(p)
        out[lang] = ranked[lang, a] if a == b else (b - p) * ranked[lang, a] + (p - a) * ranked[lang, b]
    return out


def floors(held_out: DataFrame, model: Filter) -> dict[str, float]:
    """Lowest score of a text in each language, from all labelled rows of (doc_id, text, lang) that ``model`` was not learned from."""
    rows = held_out.select("text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    reached = identify(rows, model).filter("language.lang_pred = lang").select("lang", F.col("language.score").alias("score"))
    found = {lang: MARGIN * low for lang, low in low_scores(store(reached, "langid-scores")).items()}
    return {lang: found.get(lang, min(found.values())) for lang in model.langs} if found else {}


def floor_of(lang: Column, found: dict[str, float]) -> Column:
    """The floor of a language column, 0 where there is none."""
    if not found:
        return F.lit(0.0)
    pairs = F.create_map(*[x for k, v in found.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(pairs, lang), F.lit(0.0))
