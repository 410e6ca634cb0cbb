"""Language-model scores by a Katz backoff bigram model.

Tokens of a text: its words (A-Z lower-cased, split at ASCII white space),
then one end.  A bigram's context is the token before it, or the start of
the text.  A seen bigram has the probability d(r) r / C(v): its count r,
discounted by Good-Turing, over its context's count.  The mass that the
discounts leave a context is shared among its unseen tokens in proportion
to the unigram model, P(w) = (c + 0.1) / (N + 0.1 (V + 1)), whose one extra
class is the unknown word: an unseen bigram backs off to alpha(v) P(w), and
alpha(v) = (1 - sum d(r) r / C(v)) / (1 - sum P(w) over the seen w), so each
context's probabilities sum to one.  A context never seen has alpha 1.

Discounts: r* = (r + 1) n(r+1) / n(r) for r up to ``TURING`` where that lies
below r; else the log-linear form of the same estimate, n(r) ~ r**b, which
gives d(r) = (1 + 1/r)**(b + 1) < 1 for every r, so some mass is always left.

How it is spread.  Texts are read once and written as batches: token codes
and the 64-bit hashes of the batch's distinct tokens.  The count tables are
partitioned by hash; a batch asks each partition for its distinct bigrams
and tokens (sorted blobs with the batch's own training counts), and the
partition sums the counts of all batches and answers in the same order.
So a frequent word or word pair arrives once from each batch, never once
for each occurrence, and no table, vocabulary or document set is ever in
one place.  One batch is named the owner of each distinct bigram; owners
add its share to its context's sums, which are partitioned and answered
alike.  Every step's result is a table in the shared folder.

Memory: a batch is one Arrow batch of texts (bounded bytes, at least one
text); a partition holds about ``PART_KEYS`` keys, their number follows
the corpus.  So does the number of batches; if each batch asked each
partition, the blobs would grow with the square of the corpus.  A batch
therefore asks at most 2**``FAN_BITS`` coarse partitions (key prefixes).  Where
more are needed, the blobs that about ``WIDE`` batches sent to a coarse partition
are summed into one asker, who asks the next bits in the same way and hands
the answers back: blobs grow with the corpus times the number of levels.

Edge cases: a null or empty text is one end token; null ids are scored and
count as the empty text in the split; repeated rows count as often as they
stand; without training rows every token is unknown (N = V = 0); an empty
table gives an empty result.  Hashes are 64 bits: two of n tokens or
bigrams are confused with a chance of about n**2 / 2**65.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc_mod, store

ADD = 0.1
TURING = 5
RANKS = 20  # counts of counts kept for the discounts
PART_KEYS = 1 << 20
FAN_BITS = 10  # an asker's partitions at one level: 2**FAN_BITS at most
WIDE = 1 << 10  # askers summed into one of the next level, on average
_END, _START = b" ", b"  "  # no word holds a blank

# Ids travel as text: a number column with nulls would become floating point on its way through pandas.
BATCH = "batch long, ids array<string>, held binary, sizes binary, codes binary, vocab binary, n_pairs long"
ASK = "kind int, part int, batch long, keys binary, counts binary"
ANSWER = "kind int, part int, batch long, r binary, owner binary, stats array<long>"
REST = ("kind int, part int, batch long, ids array<string>, held binary, sizes binary, known binary, base binary, score binary, "
        "open_doc binary, open_ctx binary, ctx binary, mass binary, seen binary, total binary")
CONTEXT = "part int, batch long, ctx binary, mass binary, seen binary, total binary"
ALPHA = "part int, batch long, alpha binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _hash(words) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def encode(texts: list[bytes | None]):
    """(codes of all tokens, tokens of each text, hash of each code); code 0 is the start, which stands in no text."""
    words, sizes = [], []
    for t in texts:
        w = (t or b"").lower().split()
        w.append(_END)
        words += w
        sizes.append(len(w))
    codes, vocab = pd.factorize(np.array(words, dtype=object))
    return (codes + 1).astype(np.int32), np.array(sizes, dtype=np.int64), _hash([_START, *vocab])


def _previous(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[(np.cumsum(sizes) - sizes)] = 0
    return before


def _pairs(vocab: np.ndarray, before: np.ndarray, codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        left = vocab * np.uint64(0x9E3779B97F4A7C15)
        right = (vocab ^ (vocab >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = left[before] ^ (right[codes] + np.uint64(0x94D049BB133111EB))
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def _bits(n: int) -> int:
    """Bits of the number of partitions for n keys."""
    return max(0, math.ceil(math.log2(max(1, n / PART_KEYS))))


def _cut(keys: np.ndarray, bits: int, part: int = 0, done: int = 0) -> np.ndarray:
    """Where each partition of ``bits`` bits begins in the sorted keys of a partition of ``done`` bits, and their end."""
    if bits == done:
        return np.array([0, len(keys)])
    edges = (np.uint64(part << (bits - done)) + np.arange(1, 1 << (bits - done), dtype=np.uint64)) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _cuts(keys: np.ndarray, bits: int, part: int = 0, done: int = 0):
    """(partition, begin, end) of the partitions that have keys."""
    at = _cut(keys, bits, part, done)
    return [((part << (bits - done)) + p, a, e) for p, (a, e) in enumerate(zip(at, at[1:])) if a < e]


def _numbers(x: np.ndarray) -> bytes:
    """Counts of 4 or 8 bytes, after a byte that says which."""
    kind = np.dtype(np.uint32 if not len(x) or x.max() < 1 << 32 else np.uint64)
    return bytes([kind.itemsize]) + _pack(x.astype(kind))


def _of_numbers(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=np.uint32 if x[0] == 4 else np.uint64, offset=1).astype(np.int64)


def _read(row):
    held = np.frombuffer(row["held"], dtype=bool)
    sizes = np.frombuffer(row["sizes"], dtype=np.int64)
    return held, sizes, np.frombuffer(row["codes"], dtype=np.int32), np.frombuffer(row["vocab"], dtype=np.uint64)


def batches(docs: DataFrame, held_out) -> DataFrame:
    """Texts as token codes, one row for each Arrow batch; ``held_out``: a column, true where a row is not learned from."""
    bounded_batches(docs.sparkSession)

    def rows(parts):
        task, n = TaskContext.get().partitionId(), 0
        for b in parts:
            codes, sizes, vocab = encode(list(b["text"]))
            pairs = len(np.unique(_pairs(vocab, _previous(codes, sizes), codes)))
            ids = list(b["doc_id"])
            yield pd.DataFrame({"batch": [(task << 24) + n], "ids": [ids], "held": [_pack(b["held"].to_numpy(dtype=bool))],
                                "sizes": [_pack(sizes)], "codes": [_pack(codes)], "vocab": [_pack(vocab)], "n_pairs": [pairs]})
            n += 1

    plain = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"), held_out.alias("held"))
    return store(plain.mapInPandas(rows, BATCH), "katz-batches", compression="zstd")


def _asked(coded: DataFrame, pair_bits: int, word_bits: int) -> DataFrame:
    """Each batch's distinct bigrams (kind 0) and tokens (kind 1) with its training counts, by coarse partition."""
    pair_bits, word_bits = min(pair_bits, FAN_BITS), min(word_bits, FAN_BITS)

    def rows(parts):
        for b in parts:
            for _, row in b.iterrows():
                held, sizes, codes, vocab = _read(row)
                train = ~np.repeat(held, sizes)
                before = _previous(codes, sizes)
                keys, inverse = np.unique(_pairs(vocab, before, codes), return_inverse=True)
                counts = np.bincount(inverse[train], minlength=len(keys))
                yield _blobs(0, row["batch"], keys, counts, pair_bits)
                counts = np.bincount(codes[train], minlength=len(vocab))
                counts[0] = (~held).sum()
                order = np.argsort(vocab)
                yield _blobs(1, row["batch"], vocab[order], counts[order], word_bits)

    return coded.mapInPandas(rows, ASK)


def _blobs(kind, batch, keys, counts, bits, part=0, done=0) -> pd.DataFrame:
    return pd.DataFrame([(kind, p, batch, _pack(keys[a:e]), _numbers(counts[a:e])) for p, a, e in _cuts(keys, bits, part, done)],
                        columns=["kind", "part", "batch", "keys", "counts"])


def _asks(group: pd.DataFrame):
    """One partition's keys and counts of all askers, its distinct keys, each key's place in them, and each asker's first and last key."""
    keys = np.frombuffer(b"".join(group["keys"]), dtype=np.uint64)
    counts = np.concatenate([_of_numbers(x) for x in group["counts"]])
    distinct, inverse = np.unique(keys, return_inverse=True)
    ends = np.cumsum([0, *(len(k) // 8 for k in group["keys"])])
    return keys, counts, distinct, inverse, list(zip(ends, ends[1:]))


def _learned(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where each key that has a training count has its first one."""
    had = np.flatnonzero(counts)
    return had[np.unique(keys[had], return_index=True)[1]]


def _answered(group: pd.DataFrame, r: np.ndarray, owner: np.ndarray, cut, stats) -> pd.DataFrame:
    return pd.DataFrame({
        "kind": int(group["kind"].iloc[0]), "part": int(group["part"].iloc[0]), "batch": group["batch"].to_numpy(),
        "r": [_numbers(r[a:e]) for a, e in cut],
        "owner": [_pack(np.packbits(owner[a:e])) for a, e in cut],
        "stats": [stats if i == 0 else [] for i in range(len(cut))],
    })


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """One partition of a count table: total counts, answered to each asker in its own order."""
    group = group.sort_values("batch")
    keys, counts, distinct, inverse, cut = _asks(group)
    total = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
    owner = np.zeros(len(keys), dtype=bool)
    owner[_learned(keys, counts)] = True
    if group["kind"].iloc[0] == 0:
        stats = np.bincount(total[total <= RANKS + 1], minlength=RANKS + 2)[1:].tolist()
    else:
        words = distinct != _hash([_START])[0]
        stats = [int((total[words] > 0).sum()), int(total[words].sum())]
    return _answered(group, total[inverse], owner, cut, stats)


def _groups(asked: DataFrame, askers: int) -> tuple[DataFrame, int]:
    """Askers dealt to groups (``wide``) of about ``WIDE``, and the number of groups."""
    n = -(-askers // WIDE)
    return asked.withColumn("wide", F.pmod(F.xxhash64("batch"), F.lit(n).cast("long"))), n


def _merged(bits: dict[int, int], done: int):
    """What a group of askers sent to one coarse partition, as one asker's blobs for the next bits."""

    def step(group: pd.DataFrame) -> pd.DataFrame:
        kind, part, wide = (int(group[c].iloc[0]) for c in ("kind", "part", "wide"))
        _, counts, distinct, inverse, _ = _asks(group)
        total = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
        return _blobs(kind, wide, distinct, total, min(bits[kind], done + FAN_BITS), part, done)

    return step


def _handed_back(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The answers to a group of askers, given to each of them; the first that learned a key owns what the group owns."""
    group = group.sort_values("batch")
    keys, counts, distinct, inverse, cut = _asks(group)
    r, owns = _answers(answers, int(group["kind"].iloc[0]), len(distinct))
    owner = np.zeros(len(keys), dtype=bool)
    first = _learned(keys, counts)
    owner[first] = owns[inverse[first]]
    return _answered(group, r[inverse], owner, cut, [])


def _counted(asked: DataFrame, bits: dict[int, int], askers: int, done: int) -> tuple[DataFrame, list[DataFrame]]:
    """Answers to the askers, who dealt their keys by the first ``done`` bits, and the tables that hold the statistics."""
    deep = {kind: b for kind, b in bits.items() if b > done}
    if deep:
        asked = store(asked, "katz-asked", compression="zstd")
    flat = asked.filter(~F.col("kind").isin(*deep)) if deep else asked
    answers = store(flat.groupBy("kind", "part").applyInPandas(_summed, ANSWER), "katz-counts", compression="zstd")
    if not deep:
        return answers, [answers]
    wide, n = _groups(asked.filter(F.col("kind").isin(*deep)), askers)
    below, stats = _counted(wide.groupBy("kind", "part", "wide").applyInPandas(_merged(deep, done), ASK), deep, n, done + FAN_BITS)
    up = F.lit(None).cast("int")
    for kind, b in deep.items():
        up = F.when(F.col("kind") == kind, F.expr(f"shiftright(part, {min(b - done, FAN_BITS)})")).otherwise(up)
    asking = wide.groupBy("kind", "part", "wide")
    back = asking.cogroup(below.withColumn("up", up).groupBy("kind", "up", "batch")).applyInPandas(_handed_back, ANSWER)
    return answers.unionByName(store(back, "katz-handed-back", compression="zstd")), [answers, *stats]


def _answers(group: pd.DataFrame, kind: int, n: int):
    """Counts and owner flags of a batch's sorted keys."""
    g = group[group["kind"] == kind].sort_values("part")
    r = [_of_numbers(x) for x in g["r"]]
    owner = [np.unpackbits(np.frombuffer(o, dtype=np.uint8), count=len(x)).astype(bool) for o, x in zip(g["owner"], r)]
    r, owner = np.concatenate(r), np.concatenate(owner)
    assert len(r) == n, "a partition's answer is missing"
    return r, owner


class Discounts:
    """Good-Turing discounts from counts of counts n[0] (bigrams seen once), n[1], ..."""

    def __init__(self, n: list[int]):
        ranks = np.array([i + 1 for i in range(len(n)) if n[i] > 0], dtype=float)
        found = np.array([n[i] for i in range(len(n)) if n[i] > 0], dtype=float)
        slope = -2.0
        if len(ranks) > 1:
            slope = float(np.polyfit(np.log(ranks), np.log(found), 1, w=np.sqrt(found))[0])
        self.slope = min(slope, -1.1)
        self.low = np.ones(TURING + 1)
        for r in range(1, TURING + 1):
            turing = (r + 1) * n[r] / (r * n[r - 1]) if r < len(n) and n[r - 1] else 0.0
            self.low[r] = turing if 0.0 < turing < 1.0 else (1 + 1 / r) ** (self.slope + 1)

    def of(self, r: np.ndarray) -> np.ndarray:
        """d(r) of counts of at least 1 (1 for 0)."""
        safe = np.maximum(r, 1).astype(float)
        d = (1 + 1 / safe) ** (self.slope + 1)
        small = r <= TURING
        d[small] = self.low[r[small]]
        return d


def _scored(n_tokens: int, n_words: int, discounts: Discounts, word_bits: int):
    """Per batch: all parts of the scores but the backoff weights, and the batch's share of its contexts' sums."""
    z = n_tokens + ADD * (n_words + 1)

    def step(coded: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = coded.iloc[0]
        held, sizes, codes, vocab = _read(row)
        before = _previous(codes, sizes)
        keys, first, inverse = np.unique(_pairs(vocab, before, codes), return_index=True, return_inverse=True)
        r, owner = _answers(answers, 0, len(keys))
        order = np.argsort(vocab)
        c = np.empty(len(vocab), dtype=np.int64)
        c[order] = _answers(answers, 1, len(vocab))[0]
        unigram = (c + ADD) / z
        log_unigram = np.log10(unigram)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        seen = r > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            log_seen = np.log10(discounts.of(r) * r / c[before[first]])
        token_seen = seen[inverse]
        value = np.where(token_seen, log_seen[inverse], log_unigram[codes])
        # Only texts that were not learned from have unseen bigrams.
        unseen = np.flatnonzero(~token_seen)
        mine = np.flatnonzero(owner)
        ctx = before[first[mine]]
        mass = np.bincount(ctx, weights=(discounts.of(r) * r)[mine], minlength=len(vocab))
        took = np.bincount(ctx, weights=unigram[codes[first[mine]]], minlength=len(vocab))
        count = lambda w: np.bincount(doc, weights=w, minlength=len(sizes))
        empty = b""
        rest = {"kind": 0, "part": -1, "batch": row["batch"], "ids": row["ids"], "held": row["held"], "sizes": row["sizes"],
                "known": _pack(count(c[codes] > 0).astype(np.int64)), "base": _pack(count(log_unigram[codes])), "score": _pack(count(value)),
                "open_doc": _pack(doc[unseen].astype(np.int32)), "open_ctx": _pack(np.argsort(order)[before[unseen]].astype(np.int32)),
                "ctx": empty, "mass": empty, "seen": empty, "total": empty}
        out = [rest]
        for p, a, e in _cuts(vocab[order], min(word_bits, FAN_BITS)):
            o = order[a:e]
            out.append(rest | {"kind": 1, "part": p, "ids": [], "held": empty, "sizes": empty, "known": empty, "base": empty, "score": empty,
                               "open_doc": empty, "open_ctx": empty, "ctx": _pack(vocab[o]), "mass": _pack(mass[o]), "seen": _pack(took[o]),
                               "total": _pack(c[o])})
        return pd.DataFrame(out)

    return step


def _contexts(group: pd.DataFrame):
    """One partition's distinct contexts with their sums, each asked context's place in them, and each asker's first and last one."""
    join = lambda c, t: np.frombuffer(b"".join(group[c]), dtype=t)
    distinct, inverse = np.unique(join("ctx", np.uint64), return_inverse=True)
    mass, seen = (np.bincount(inverse, weights=join(c, float), minlength=len(distinct)) for c in ("mass", "seen"))
    total = np.zeros(len(distinct), dtype=np.int64)
    total[inverse] = join("total", np.int64)
    ends = np.cumsum([0, *(len(k) // 8 for k in group["ctx"])])
    return distinct, mass, seen, total, inverse, list(zip(ends, ends[1:]))


def _alpha_rows(group: pd.DataFrame, alpha: np.ndarray, cut) -> pd.DataFrame:
    return pd.DataFrame({"part": int(group["part"].iloc[0]), "batch": group["batch"].to_numpy(), "alpha": [_pack(alpha[a:e]) for a, e in cut]})


def _alphas(group: pd.DataFrame) -> pd.DataFrame:
    """One partition of the context table: backoff weights, answered to each asker in its own order."""
    group = group.sort_values("batch")
    _, mass, seen, total, inverse, cut = _contexts(group)
    left = np.where(total > 0, 1 - mass / np.maximum(total, 1), 1.0)
    alpha = np.log10(np.maximum(left, 1e-300) / np.maximum(1 - seen, 1e-300))
    return _alpha_rows(group, alpha[inverse], cut)


def _merged_contexts(bits: int, done: int):
    """What a group of askers sent to one coarse partition of the contexts, as one asker's blobs for the next bits."""

    def step(group: pd.DataFrame) -> pd.DataFrame:
        part, wide = int(group["part"].iloc[0]), int(group["wide"].iloc[0])
        distinct, mass, seen, total, _, _ = _contexts(group.sort_values("batch"))
        cut = _cuts(distinct, min(bits, done + FAN_BITS), part, done)
        return pd.DataFrame([(p, wide, *(_pack(x[a:e]) for x in (distinct, mass, seen, total))) for p, a, e in cut],
                            columns=["part", "batch", "ctx", "mass", "seen", "total"])

    return step


def _alphas_back(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("batch")
    inverse, cut = _contexts(group)[4:]
    alpha = np.frombuffer(b"".join(answers.sort_values("part")["alpha"]), dtype=float)
    return _alpha_rows(group, alpha[inverse], cut)


def _weights(asked: DataFrame, bits: int, askers: int, done: int) -> DataFrame:
    """Backoff weights of the askers' contexts, which they dealt by the first ``done`` bits."""
    if bits <= done:
        return asked.groupBy("part").applyInPandas(_alphas, ALPHA)
    wide, n = _groups(asked, askers)
    asking = wide.groupBy("part", "wide")
    below = store(asking.applyInPandas(_merged_contexts(bits, done), CONTEXT), "katz-contexts", compression="zstd")
    answers = _weights(below, bits, n, done + FAN_BITS).withColumn("up", F.expr(f"shiftright(part, {min(bits - done, FAN_BITS)})"))
    return asking.cogroup(answers.groupBy("up", "batch")).applyInPandas(_alphas_back, ALPHA)


def _finished(rest: pd.DataFrame, alphas: pd.DataFrame) -> pd.DataFrame:
    row = rest.iloc[0]
    alpha = np.frombuffer(b"".join(alphas.sort_values("part")["alpha"]), dtype=float)
    doc, ctx = np.frombuffer(row["open_doc"], dtype=np.int32), np.frombuffer(row["open_ctx"], dtype=np.int32)
    sizes = np.frombuffer(row["sizes"], dtype=np.int64)
    score = np.frombuffer(row["score"], dtype=float) + np.bincount(doc, weights=alpha[ctx], minlength=len(sizes))
    ids = pd.array([None if x is None else int(x) for x in row["ids"]], dtype="Int64")
    return pd.DataFrame({"doc_id": ids, "held_out": np.frombuffer(row["held"], dtype=bool), "n_tokens": sizes,
                         "n_known": np.frombuffer(row["known"], dtype=np.int64), "base_score": np.frombuffer(row["base"], dtype=float), "score": score})


def scores(docs: DataFrame, held_out=None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row, learning from those not held out."""
    held_out = crc_mod(F.col("doc_id"), 10) == 0 if held_out is None else held_out
    coded = batches(docs, held_out)
    size = F.coalesce(F.sum("n_pairs"), F.lit(0)), F.coalesce(F.sum(F.length("vocab") / 8), F.lit(0))
    n_batches, n_pairs, n_vocab = coded.agg(F.count("*"), *size).first()
    pair_bits, word_bits = _bits(n_pairs), _bits(int(n_vocab))
    asked = _asked(coded.select("batch", "held", "sizes", "codes", "vocab"), pair_bits, word_bits)
    answers, tables = _counted(asked, {0: pair_bits, 1: word_bits}, n_batches, FAN_BITS)
    stats = reduce(DataFrame.unionByName, tables).select("kind", F.posexplode("stats").alias("i", "n"))
    stats = stats.groupBy("kind", "i").agg(F.sum("n").alias("n")).collect()
    of = {(r["kind"], r["i"]): r["n"] for r in stats}
    n_words, n_tokens = of.get((1, 0), 0), of.get((1, 1), 0)
    discounts = Discounts([of.get((0, i), 0) for i in range(RANKS + 1)])
    step = _scored(n_tokens, n_words, discounts, word_bits)
    rest = coded.drop("n_pairs").groupBy("batch").cogroup(answers.drop("stats").groupBy("batch")).applyInPandas(step, REST)
    rest = store(rest, "katz-rest", compression="zstd")
    asked = rest.filter("kind = 1").select("part", "batch", "ctx", "mass", "seen", "total")
    alphas = _weights(asked, word_bits, n_batches, FAN_BITS)
    ends = rest.filter("kind = 0").select("batch", "ids", "held", "sizes", "known", "base", "score", "open_doc", "open_ctx")
    done = ends.groupBy("batch").cogroup(alphas.groupBy("batch")).applyInPandas(_finished, SCORES)
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
