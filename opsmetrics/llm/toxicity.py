"""Toxic spans by a linear-chain conditional random field.

Training labels are per document, so token labels are made first: over a
bounded sample of labelled documents, a word or word beginning whose
documents are toxic far more often than chance allows (binomial
log-likelihood ratio against the number of candidates) marks its tokens
in toxic documents; all other tokens are clean.  Of copies and
near copies (texts whose four smallest word hashes agree) one is counted,
so that the words of a text that stands often are no sign.  The field has two states;
a token's features are its word, its beginnings and ends, its length and a
bias, so unseen forms of a marked stem are recognised.  It is fitted by
gradient ascent on the sample's exact conditional likelihood.

Scoring: forward-backward marginals of every token of the whole text give
the toxic spans (marginal at least ``SPAN``) with offsets into the text;
the document score is a logistic function of the highest marginal and the
sum of marginals, fitted on the sample and weighted back to the real share
of toxic documents.

The chain is evaluated for a whole batch of texts at once: its 2x2 steps
are multiplied in blocks, and a document's first step forgets what stands
before it.

Bounds: at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents, in the
order of a hash, give the word statistics, and ``FIT_TOXIC`` and
``FIT_CLEAN`` of them the field; the model (feature weights that are not
near zero) is bounded by that sample and sent to every task.

Edge cases: null and empty texts have no tokens and the score of a text
without signs; null labels are not learned from; a document with several
labels is learned once for each; without labels of both kinds every score
is the share of toxic labels (0 without any); repeated rows are scored
alike; a null id counts as the empty text in the split.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, bounded_sample, store

SAMPLE_TOXIC, SAMPLE_CLEAN = 6000, 12000
FIT_TOXIC, FIT_CLEAN = 500, 500
PART_DOCS = 256  # sampled documents whose words one task counts
ROUNDS = 45
PENALTY = 0.3
LEAST_WEIGHT = 0.02
SPAN = 0.5
THRESHOLD = 0.7
CHARS = 1_000_000  # of texts whose chains are evaluated side by side
CACHE = 100_000  # words whose emission a worker remembers

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_BEGIN, _END = (3, 4, 5, 6), (3, 4)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def features(word: str) -> list[str]:
    found = ["bias", f"w={word}", f"n={min(len(word), 12)}"]
    found += [f"b={word[:k]}" for k in _BEGIN if len(word) > k]
    found += [f"e={word[-k:]}" for k in _END if len(word) > k]
    return found


def stems(word: str) -> list[str]:
    """What a marked token may be known by: its word and its longer beginnings."""
    return [f"w={word}"] + [f"b={word[:k]}" for k in _BEGIN if len(word) > k >= 4]


# ---- the chain -------------------------------------------------------------------------------------------------------


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Ratios r[t] = v1 / v0 of v[t] = v[t-1] ((a, b), (c, d))[t], v[-1] = (1, 1).

    The steps are cut into blocks that are worked side by side: first each
    block's product of steps, then the ratio at each block's start, then
    the ratios inside.
    """
    n = len(a)
    rows = max(1, int(math.sqrt(n)))
    blocks = -(-n // rows)
    # Step t of every block in one contiguous row; identity steps at the end.
    a, b, c, d = (np.ascontiguousarray(np.append(x, np.full(blocks * rows - n, fill)).reshape(blocks, rows).T) for x, fill in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    p, q, s, t = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for i in range(rows):
        p, q, s, t = p * a[i] + q * c[i], p * b[i] + q * d[i], s * a[i] + t * c[i], s * b[i] + t * d[i]
        if i % 8 == 7:
            scale = 1 / (p + q + s + t)
            p, q, s, t = p * scale, q * scale, s * scale, t * scale
    start = np.empty(blocks)
    r = 1.0
    for k in range(blocks):
        start[k] = r
        r = (q[k] + t[k] * r) / (p[k] + s[k] * r)
    out = np.empty((rows, blocks))
    r = start
    for i in range(rows):
        r = (b[i] + d[i] * r) / (a[i] + c[i] * r)
        out[i] = r
    return out.T.reshape(-1)[:n]


def marginals(emit: np.ndarray, first: np.ndarray, moves: np.ndarray, with_moves: bool = True):
    """Probability of the toxic state of each token, and the expected moves (2x2 sums over all pairs of neighbours).

    ``emit``: log-odds of the toxic state; ``first``: whether a token
    opens its document; ``moves``: log weights of state changes.
    """
    n = len(emit)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    e = np.clip(emit, -40, 40)
    low = np.minimum(e, 0)
    w0, w1 = np.exp(low - e), np.exp(low)  # scaled so that the larger is 1
    (s00, s01), (s10, s11) = np.exp(moves)
    # A document's first token takes nothing from the one before it.
    forward = _scan(np.where(first, w0, s00 * w0), np.where(first, w1, s01 * w1), np.where(first, w0, s10 * w0), np.where(first, w1, s11 * w1))
    # Backward, from the end: a document's last token forgets what follows.
    last = np.append(first[1:], True)
    n0, n1 = np.append(w0[1:], 1.0), np.append(w1[1:], 1.0)
    steps = (np.where(last, 1.0, x)[::-1] for x in (s00 * n0, s10 * n0, s01 * n1, s11 * n1))
    backward = _scan(*steps)[::-1]
    odds = forward * backward
    p = odds / (1 + odds)
    if not with_moves:
        return p, None
    pairs = np.flatnonzero(~first)
    f, g, u0, u1 = forward[pairs - 1], backward[pairs], w0[pairs], w1[pairs]
    joint = np.stack([s00 * u0, s01 * u1 * g, f * s10 * u0, f * s11 * u1 * g])
    return p, (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)


class Field:
    """Feature weights (log-odds of the toxic state), state moves and the document score's logistic weights."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray, calibration: np.ndarray, share: float):
        self.weights, self.moves, self.calibration, self.share = weights, moves, calibration, share
        self._known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_known": {}}

    def emission(self, word: str) -> float:
        value = self._known.get(word)
        if value is None:
            get = self.weights.get
            value = sum(get(f, 0.0) for f in features(word))
            if len(self._known) >= CACHE:
                self._known.clear()
            self._known[word] = value
        return value

    def tag(self, texts: list[str | None]) -> list[np.ndarray]:
        """Toxic marginal of every token of each text."""
        words = [tokens(t) for t in texts]
        sizes = np.array([len(w) for w in words])
        known, emission = self._known, self.emission
        emit = np.array([known[w] if w in known else emission(w) for ws in words for w in ws], dtype=float)
        first = np.zeros(len(emit), dtype=bool)
        ends = np.cumsum(sizes)
        first[(ends - sizes)[sizes > 0]] = True
        p, _ = marginals(emit, first, self.moves, with_moves=False)
        return np.split(p, ends[:-1])

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        if not len(self.calibration):
            return np.full(len(found), self.share)
        return 1 / (1 + np.exp(-np.clip(_signs(found) @ self.calibration, -30, 30)))


def _signs(found: list[np.ndarray]) -> np.ndarray:
    """A document's features: 1, log-odds of the highest marginal, log of the sum of noteworthy marginals."""
    out = np.ones((len(found), 3))
    for i, p in enumerate(found):
        top = min(max(p.max() if len(p) else 0.0, 1e-4), 1 - 1e-4)
        out[i, 1] = math.log(top / (1 - top)) / 9
        out[i, 2] = math.log1p(float(p[p > 0.1].sum()))
    return out


# ---- fitting ---------------------------------------------------------------------------------------------------------


def _sketch(text: Column) -> Column:
    """The four smallest hashes of a text's words: the same for copies and for most near copies."""
    words = F.split(F.lower(text), r"\s+")
    return F.slice(F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))), 1, 4)


def _seeds(sample: DataFrame) -> set[str]:
    """Words and beginnings whose documents are toxic far beyond chance; counted by Spark over the sample."""

    def count(batches):
        seen = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"]):
                seen[toxic].update({s for w in set(tokens(text)) for s in stems(w)})
        keys = list(seen[0].keys() | seen[1].keys())
        if not keys:  # an empty partition has nothing to say, and empty columns no type
            return
        yield pd.DataFrame({"stem": keys, "clean": [seen[0][k] for k in keys], "toxic": [seen[1][k] for k in keys]})

    counts = sample.mapInPandas(count, "stem string, clean long, toxic long").groupBy("stem")
    counts = store(counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "tox-stems")
    all_clean, all_toxic, n = counts.agg(F.sum("clean"), F.sum("toxic"), F.count("*")).first()
    if not all_clean or not all_toxic:
        return set()
    base = all_toxic / (all_toxic + all_clean)
    c, t = F.col("clean").cast("double"), F.col("toxic").cast("double")
    share = t / (t + c)
    ratio = t * F.log(share / base) + F.when(c > 0, c * F.log((1 - share) / (1 - base))).otherwise(0.0)
    marked = counts.filter((t > 0) & (share > 0.8) & (share > base) & (ratio > math.log(n) + 3))
    return {r["stem"] for r in marked.select("stem").collect()}


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small penalty, by Newton's method."""
    b = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (w * (y - p)) - 1e-2 * b
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(b))
        step = np.linalg.solve(curve, slope)
        b = b + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return b


def _fit_field(texts: list[str], toxic: np.ndarray, seeds: set[str]) -> tuple[dict[str, float], np.ndarray]:
    """Weights and moves by Adagrad on the log-likelihood."""
    words = [tokens(t) for t in texts]
    sizes = np.array([len(w) for w in words])
    codes, vocab = pd.factorize(np.array([w for ws in words for w in ws], dtype=object))
    del words
    doc = np.repeat(np.arange(len(sizes)), sizes)
    marked = np.array([any(s in seeds for s in stems(w)) for w in vocab], dtype=bool)
    state = (marked[codes] & (toxic[doc] == 1)).astype(int)
    first = np.ones(len(codes), dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    inner = np.flatnonzero(~first)
    seen = np.bincount(state[inner - 1] * 2 + state[inner], minlength=4).reshape(2, 2).astype(float)
    listed = [features(w) for w in vocab]
    of = np.repeat(np.arange(len(vocab)), [len(f) for f in listed])
    feature, names = pd.factorize(np.array([f for fs in listed for f in fs], dtype=object))
    del listed
    weights, moves = np.zeros(len(names)), np.zeros((2, 2))
    weights[names == "bias"] = -3.0
    g_w, g_m = np.full(len(names), 1e-6), np.full((2, 2), 1e-6)
    target = np.bincount(codes, weights=state, minlength=len(vocab))
    for _ in range(ROUNDS):
        emission = np.bincount(of, weights=weights[feature], minlength=len(vocab))
        p, expected = marginals(emission[codes], first, moves)
        gap = target - np.bincount(codes, weights=p, minlength=len(vocab))
        slope = np.bincount(feature, weights=gap[of], minlength=len(names)) - PENALTY * weights
        slope_m = seen - expected - PENALTY * moves
        g_w += slope**2
        g_m += slope_m**2
        weights += 0.7 * slope / np.sqrt(g_w)
        moves += 0.2 * slope_m / np.sqrt(g_m)
    kept = np.flatnonzero((np.abs(weights) >= LEAST_WEIGHT) | (names == "bias"))
    return {str(names[i]): float(weights[i]) for i in kept}, moves


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """Field from documents (doc_id, text) and their labels (doc_id, toxic 0 or 1).

    The sample is drawn from the ids alone; only its texts are read, by a
    join with a table that the sample bounds hold small.
    """
    bounded_batches(docs.sparkSession)
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    rows = store(docs.select("doc_id").join(marks, "doc_id"), "tox-labelled")
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if len(totals) < 2:
        return Field({}, np.zeros((2, 2)), np.zeros(0), share)
    chosen = store(bounded_sample(rows, "toxic", ["doc_id"], {0: SAMPLE_CLEAN, 1: SAMPLE_TOXIC}), "tox-chosen")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id")
    first = [F.min_by(c, "nth").alias(c) for c in ("doc_id", "text")]  # of copies, the first in the sample's order
    sample = sample.groupBy("toxic", _sketch(F.col("text")).alias("sketch")).agg(*first, F.min("nth").alias("nth"))
    sample = store(sample.drop("sketch"), "tox-sample")
    seeds = _seeds(sample.repartition(-(-max(1, sample.count()) // PART_DOCS)))
    part = []
    for mark, size in ((0, FIT_CLEAN), (1, FIT_TOXIC)):
        part += sample.filter(F.col("toxic") == mark).orderBy("nth", "text").limit(size).select("text", "toxic").collect()
    texts, toxic = [r["text"] for r in part], np.array([r["toxic"] for r in part])
    del part
    weights, moves = _fit_field(texts, toxic, seeds)
    field = Field(weights, moves, np.ones(3), share)
    found = []
    for i in range(0, len(texts), 200):
        found += field.tag(texts[i : i + 200])
    each = np.where(toxic == 1, totals[1] / max(1, (toxic == 1).sum()), totals[0] / max(1, (toxic == 0).sum()))
    return Field(weights, moves, _logistic(_signs(found), toxic, each / each.mean()), share)


def scored(docs: DataFrame, field: Field, out: str = "toxicity", text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``out``: score, spans (character offsets of toxic tokens, neighbours joined)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(field)

    @F.pandas_udf("score double, spans array<struct<start:int,stop:int>>")
    def score(texts: pd.Series) -> pd.DataFrame:
        field = held.value
        values, spans = [], []
        piece = np.cumsum([len(t) if t else 0 for t in texts]) // CHARS
        for _, part in texts.groupby(piece, sort=False):
            part = list(part)
            found = field.tag(part)
            values.append(field.scores(found))
            spans += [_spans(t, p) for t, p in zip(part, found)]
        return pd.DataFrame({"score": np.concatenate(values) if values else np.zeros(0), "spans": spans})

    return docs.withColumn(out, score(F.col(text)))


def _spans(text: str | None, p: np.ndarray) -> list[dict]:
    if not len(p) or p.max() < SPAN:
        return []
    low = text.lower()
    # Lower-casing may lengthen a text; then offsets are of the case-folded one letter by letter.
    at = [m.span() for m in _TOKEN.finditer(low)]
    if len(low) != len(text):
        back = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
        back = np.append(back, len(text))
        at = [(int(back[a]), int(back[b - 1]) + 1) for a, b in at]
    hit = np.flatnonzero(p >= SPAN)
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return [{"start": at[r[0]][0], "stop": at[r[-1]][1]} for r in runs]
