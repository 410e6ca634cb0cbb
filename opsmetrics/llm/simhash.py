"""SimHash near-duplicates by a binary trie self-join.

Fingerprint: 64 bits; a bit is set where over half of the XXH64 values of
the text's word shingles have it.  Equal fingerprints are one node of the
join, so a group of exact copies costs one row.

Join: the distinct fingerprints form a binary trie.  Pairs of trie nodes
are walked together from the top bit; a differing bit adds to the pair's
error and a pair over the budget is dropped with all that hangs below it.
Two fingerprints that differ in at most ``distance`` bits differ in at most
half of them in one of their two 32-bit halves, so the walk is made twice,
once with each half on top, with half the budget for the first 32 levels
and the whole budget below.  That keeps both tries' walks short and loses
no link.

Spread: the top ``b`` levels are walked by giving each fingerprint to the
node pairs (its prefix, a prefix within the budget); each pair of nodes is
one task's work.  ``b`` grows with the logarithm of the distinct
fingerprints, so a node stays small.  A node that is still over
``NODE_ROWS`` (many near copies that share their prefix) is cut into
pieces by hash, and all pairs of pieces are joined.  A task returns a
spanning forest of the links it finds, not all pairs: the components are
the same and a dense group costs rows in proportion to its size.

Edge cases: a null, empty or blank text has no words; its fingerprint is 0,
linked like any other.  Rows with a null id are fingerprinted and linked
but never name a component; a component of such rows only has a null id.
Repeated rows and ids stay as rows.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, store
from .components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
NODE_ROWS = 1 << 14  # fingerprints under one trie node, as planned from their number
PIECE_ROWS = 1 << 18  # a node with more is cut into pieces
MAX_BITS = 16
LEAF = 64  # node pairs with at most so many fingerprint pairs are compared directly
CHUNK = 1 << 18  # node pairs walked at once
DEAL = 1 << 20  # fingerprints dealt out at once


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(words[i:] for i in range(shingle)))
    hashes = np.fromiter((digest(join(g), SEED) for g in grams), dtype="<u8", count=len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = hashes[i : i + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(None if t is None else bytes(t), shingle) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return fp(text.cast("binary"))


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# ---- the walk of two tries -------------------------------------------------------------------------------------------


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of n nodes' groups under the links (a, b)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _expand(la, na, lb, nb):
    """All index pairs of the node pairs with starts la, lb and sizes na, nb."""
    size = na * nb
    pair = np.repeat(np.arange(len(size)), size)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
    return la[pair] + k // nb[pair], lb[pair] + k % nb[pair]


def trie_links(left: np.ndarray, right: np.ndarray | None, depth: int, errors: int, distance: int):
    """Links (values a, b) of a spanning forest over pairs within ``distance`` bits.

    ``left`` and ``right`` (None: self-join) are sorted, distinct, unsigned
    64-bit arrays, each under one trie node of ``depth`` whose prefixes
    differ in ``errors`` bits.  Half the budget holds for the first 32 bits.
    """
    self_join = right is None
    every = left if self_join else np.concatenate([left, right])
    shift = 0 if self_join else len(left)
    values_b = left if self_join else right
    n_a, n_b = len(left), len(values_b)
    if not n_a or not n_b:
        return every[:0], every[:0]
    found_a, found_b, pending = [], [], 0
    top = np.uint64(0)
    if depth:
        top = ~np.uint64((1 << (64 - depth)) - 1)
    one = lambda x: np.array([x])
    stack = [(depth, one(0), one(n_a), one(0), one(n_b), one(errors), left[:1] & top, values_b[:1] & top)]
    while stack:
        d, la, ha, lb, hb, err, pa, pb = stack.pop()
        if len(la) > CHUNK:
            half = len(la) // 2
            stack += [(d, *(x[:half] for x in (la, ha, lb, hb, err, pa, pb))), (d, *(x[half:] for x in (la, ha, lb, hb, err, pa, pb)))]
            continue
        sure = err + (64 - d) <= distance  # whatever lies below is within the budget: a chain links it
        small = ((ha - la) * (hb - lb) <= LEAF) & ~sure
        if sure.any():
            for a0, a1, b0, b1 in zip(la[sure], ha[sure], lb[sure], hb[sure]):
                i, j = np.arange(a0, a1), np.arange(b0, b1) + shift
                found_a += [np.repeat(i[:1], len(j)), i[1:]]
                found_b += [j, np.repeat(j[:1], len(i) - 1)]
                pending += len(i) + len(j)
        if small.any():
            i, j = _expand(la[small], (ha - la)[small], lb[small], (hb - lb)[small])
            near = np.bitwise_count(left[i] ^ values_b[j]) <= distance
            if self_join:
                near &= i < j
            found_a.append(i[near])
            found_b.append(j[near] + shift)
            pending += int(near.sum())
        if pending > 1 << 22:
            root = _forest(len(every), np.concatenate(found_a), np.concatenate(found_b))
            node = np.flatnonzero(root != np.arange(len(every)))
            found_a, found_b, pending = [root[node]], [node], len(node)
        go = ~(small | sure)
        if not go.any():
            continue
        la, ha, lb, hb, err, pa, pb = (x[go] for x in (la, ha, lb, hb, err, pa, pb))
        bit = np.uint64(1) << np.uint64(63 - d)
        ma, mb = np.searchsorted(left, pa | bit), np.searchsorted(values_b, pb | bit)
        ma, mb = np.clip(ma, la, ha), np.clip(mb, lb, hb)
        limit = distance // 2 if d + 1 <= 32 else distance
        kids = []
        for side_a in (0, 1):
            a0, a1 = (la, ma) if side_a == 0 else (ma, ha)
            for side_b in (0, 1):
                b0, b1 = (lb, mb) if side_b == 0 else (mb, hb)
                e = err + (side_a != side_b)
                ok = (a1 > a0) & (b1 > b0) & (e <= limit)
                if self_join and side_a > side_b:
                    ok &= pa != pb  # within one node, (1, 0) repeats (0, 1)
                kids.append([x[ok] for x in (a0, a1, b0, b1, e, pa | (bit * np.uint64(side_a)), pb | (bit * np.uint64(side_b)))])
        stack.append((d + 1, *(np.concatenate(x) for x in zip(*kids))))
    if not found_a:
        return every[:0], every[:0]
    root = _forest(len(every), np.concatenate(found_a), np.concatenate(found_b))
    node = np.flatnonzero(root != np.arange(len(every)))
    return every[root[node]], every[node]


# ---- spread over tasks -----------------------------------------------------------------------------------------------


def _rotate(values: np.ndarray, turn: int) -> np.ndarray:
    return (values << np.uint64(32)) | (values >> np.uint64(32)) if turn else values


def links(fps: DataFrame, distance: int = DISTANCE, node_rows: int = NODE_ROWS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(a, b): links whose components are those of all pairs of the distinct longs ``fps`` within ``distance`` bits."""
    bounded_batches(fps.sparkSession)
    (name,) = fps.columns
    n = fps.count()
    bits = min(MAX_BITS, max(2, math.ceil(math.log2(max(1, n / node_rows)))))
    masks = np.array([m for m in range(1 << bits) if m.bit_count() <= distance // 2], dtype=np.int64)
    # Fingerprints under each node, of either trie: at most 2 * 2**MAX_BITS numbers.
    unsigned_prefix = lambda turn: F.shiftrightunsigned(F.shiftleft(F.col(name), 32 * turn), 64 - bits)
    node = F.explode(F.array(*[F.struct(F.lit(t).alias("turn"), unsigned_prefix(t).alias("prefix")) for t in (0, 1)]))
    full = fps.select(node.alias("n")).groupBy("n.turn", "n.prefix").count().filter(F.col("count") > piece_rows).collect()
    pieces = {(r["turn"], r["prefix"]): -(-r["count"] // piece_rows) for r in full}

    def deal(batches):
        """Each fingerprint to all node pairs of its prefix, as one blob for each pair and ``DEAL`` fingerprints."""
        held, size = [], 0
        for batch in batches:
            held.append(batch[name].to_numpy().view(np.uint64))
            size += len(held[-1])
            if size >= DEAL:
                yield dealt_blobs(np.concatenate(held))
                held, size = [], 0
        if size:
            yield dealt_blobs(np.concatenate(held))

    def dealt_blobs(values):
        rows = []
        for turn in (0, 1):
            turned = np.sort(_rotate(values, turn))
            prefix = (turned >> np.uint64(64 - bits)).astype(np.int64)
            start = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1]))) if len(prefix) else []
            for s, e in zip(start, np.append(start[1:], len(prefix)) if len(prefix) else []):
                p = int(prefix[s])
                mine = pieces.get((turn, p), 1)
                own = turned[s:e]
                of = (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % mine
                for c in range(mine):
                    blob = own[of == c].tobytes() if mine > 1 else own.tobytes()
                    if not blob:
                        continue
                    for q in (p ^ masks).tolist():
                        for other in range(pieces.get((turn, q), 1)):
                            lo, hi = sorted([(p, c), (q, other)])
                            rows.append((turn, lo[0], hi[0], lo[1], hi[1], int((p, c) != lo), blob))
        return pd.DataFrame(rows, columns=["turn", "p", "q", "i", "j", "side", "blob"])

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        turn, p, q, i, j = (int(group[c].iloc[0]) for c in ("turn", "p", "q", "i", "j"))
        side = lambda s: np.sort(np.frombuffer(b"".join(group["blob"][group["side"] == s]), dtype=np.uint64))
        right = None if (p, i) == (q, j) else side(1)
        a, b = trie_links(side(0), right, bits, (p ^ q).bit_count(), distance)
        return pd.DataFrame({"a": _rotate(a, turn).view(np.int64), "b": _rotate(b, turn).view(np.int64)})

    dealt = fps.mapInPandas(deal, "turn int, p int, q int, i int, j int, side int, blob binary")
    return dealt.groupBy("turn", "p", "q", "i", "j").applyInPandas(walk, "a long, b long")


def classes(docs: DataFrame, fp: str, doc_id: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """(fp, component_id): for each distinct fingerprint the smallest id reachable over links."""
    smallest = store(docs.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first_id")), "simhash-fps")
    roots = components(links(smallest.select("fp"), distance))
    rooted = smallest.join(roots, smallest["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    rooted = store(rooted, "simhash-roots")
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(names, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    marked = store(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-docs")
    by_fp = classes(marked, "fp", distance=distance)
    return marked.join(by_fp, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component stays: the smallest id (ids before null), of equal ids the smallest row hash.

    The decision table (component, id, row hash) holds no text.  Documents
    meet it in one shuffle on (id, row hash); rows equal in every column
    are told apart there by a row number that needs no further shuffle.
    """
    bounded_batches(docs.sparkSession)
    row = F.xxhash64(*[F.col(c) for c in docs.columns])
    marked = store(docs.select("doc_id", row.alias("row"), fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-docs")
    smallest = store(marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")).alias("first")), "simhash-fps")
    roots = components(links(smallest.select("fp"), distance))
    rooted = smallest.join(roots, smallest["fp"] == roots["node"], "left").select(F.coalesce("root", "fp").alias("root"), "first")
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("__id"), F.col("first.row").alias("__row"))
    kept = kept.withColumn("__id", F.coalesce(F.col("__id").cast("string"), F.lit("")))
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "__row": row})
    nth = F.row_number().over(W.partitionBy("__id", "__row").orderBy("__row"))
    stays = keyed.join(kept, ["__id", "__row"], "left_semi").withColumn("__nth", nth).filter("__nth = 1")
    return stays.drop("__id", "__row", "__nth")
