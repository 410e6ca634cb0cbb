"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Index: vectors are dealt to shards by a hash of their id; a shard is
always about ``SHARD_ROWS`` vectors, their number follows the table.
Within a shard equal vectors are one node, so a vector that a third of all
rows share costs one node in each shard.  Nodes are lifted by one
coordinate to equal length, which makes the largest inner product the
smallest distance; the longest nodes of a shard (``LISTED`` and all beyond ``LONG`` times its median) stand in a list beside the graph that every
query is compared with, so a few very long vectors do not drown the others' distances.  Nodes are scaled
by the graph's longest before single precision.  They are inserted in growing batches: a greedy beam
search over the graph so far proposes neighbours; robust pruning keeps the
nearest proposal, drops those that lie nearer to it (by the factor
``ALPHA``) than to the node, and goes on; reverse links are pruned alike.
Nodes that no path reaches get a link from the nearest reached node with
a spare place.

Search: queries are packed into blocks; every block meets every shard's
graph once, and a beam search returns the shard's best; its beam is
narrower where many shards share a query's neighbours.  They are scored
exactly, in double precision on the original vectors, and ranked over all
shards (Spark keeps only a task's best for each query before it shuffles
them).

Edge cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do null ids; an id that stands several times
counts once, with its smallest vector; vectors are compared with those of
their own length only; ties go to the smaller id; a query with fewer
candidates gets them all; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, store

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
DEGREE = 28
SPARE = 4
BUILD_BEAM = 64
SEARCH_BEAM = 320  # of a table's only shard
LEAST_BEAM = 160  # of one shard of many, which holds few of a query's neighbours
LISTED = 32
LONG = 2.0  # times the shard's median length: longer nodes are listed, too
ALPHA = 1.2
STEP = 512  # searches made side by side, fewer
MET_BYTES = 1 << 22  # where their tables of met nodes would be larger
EXPAND = 4  # nodes that a search expands before it sorts its beam
_NONE = (1 << 63) - 1

INDEX = "dim int, shard int, ids binary, starts binary, vectors binary, graph binary, entry int"


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors in proportion, the longest of length 1."""
    x = x / max(float(np.abs(x).max(initial=0.0)), np.finfo(float).tiny)
    return x / max(float(np.sqrt((x * x).sum(axis=1).max(initial=0.0))), np.finfo(float).tiny)


def lifted(x: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate, all of the same length."""
    x = scaled(x)
    square = (x * x).sum(axis=1)
    return np.concatenate([x, np.sqrt(np.maximum(square.max() - square, 0))[:, None]], axis=1).astype(np.float32)


def _keys(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Inner products and nodes as one number each, best first; the lowest bit is for nodes that are expanded."""
    bits = (-near + np.float32(0)).view(np.int32)
    return ((bits ^ ((bits >> 31) & 0x7FFFFFFF)).astype(np.int64) << 32) | (ids.astype(np.int64) << 1)


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int, trail: bool = False):
    """Nodes nearest to each query by inner product, best first (-1: none); with ``trail`` also the nodes it went through.

    A beam is a sorted row of ``_keys``, and a query scores a node once; so a
    step costs the nodes it scores and one sort of the beam for ``EXPAND`` expansions.
    """
    n, degree = len(queries), graph.shape[1]
    state = np.full((n, beam), _NONE)
    state[:, 0] = _keys(queries @ x[entry], np.full(n, entry))
    met = np.full(n * len(x), -1, dtype=np.int32)  # the step's place at which a query met a node
    met[np.arange(n) * len(x) + entry] = 0
    trails = []
    live = np.arange(n)
    while len(live):
        beams = state[live]
        ready = (beams & 1) == 0
        nth = np.cumsum(ready, axis=1, dtype=np.int32)
        row, col = np.nonzero(ready & (nth <= EXPAND))  # the nearest that are not yet expanded
        slot = nth[row, col] - 1
        node = (beams[row, col] & 0xFFFFFFFF) >> 1
        beams[row, col] |= 1
        if trail:
            went = np.full((n, EXPAND), -1, dtype=np.int32)
            went[live[row], slot] = node
            trails.append(went)
        out = graph[node]
        pair, link = np.nonzero(out >= 0)
        to = out[pair, link]
        at = live[row[pair]] * len(x) + to
        new = np.flatnonzero(met[at] < 0)
        at = at[new]
        place = np.arange(len(new), dtype=np.int32)
        met[at] = place
        once = met[at] == place  # two expanded nodes may link to one
        new = new[once]
        pair, link, to = pair[new], link[new], to[new]
        fresh = np.full((len(live), EXPAND * degree), _NONE)
        score = np.einsum("bd,bd->b", x[to], queries[live[row[pair]]], optimize=False)
        fresh[row[pair], slot[pair] * degree + link] = _keys(score, to)
        both = np.concatenate([beams, fresh], axis=1)
        both.sort(axis=1)
        state[live] = both[:, :beam]
        live = live[((both[:, :beam] & 1) == 0).any(axis=1)]
    ids = np.where(state == _NONE, -1, (state & 0xFFFFFFFF) >> 1).astype(np.int32)
    if trail:
        return ids, np.concatenate([*trails, ids], axis=1)
    return ids


def robust_prune(x: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node among its proposals (-1: no proposal)."""
    order = np.sort(proposed, axis=1)
    order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
    order[order == nodes[:, None]] = -1
    n, width = len(order), max(1, int((order >= 0).sum(axis=1).max(initial=0)))
    order = np.sort(order, axis=1)[:, -width:]  # each proposal once
    valid = order >= 0
    points = x[np.maximum(order, 0)]
    among = np.matmul(points, points.transpose(0, 2, 1))
    length = np.einsum("bwd,bwd->bw", points, points)
    own = x[nodes]
    to_node = np.maximum(length + (own * own).sum(axis=1)[:, None] - 2 * np.einsum("bwd,bd->bw", points, own), 0)
    out = np.full((n, degree), -1, dtype=np.int32)
    rows = np.arange(n)
    for k in range(degree):
        cost = np.where(valid, to_node, np.inf)
        best = np.argmin(cost, axis=1)
        ok = np.isfinite(cost[rows, best])
        if not ok.any():
            break
        out[ok, k] = order[rows, best][ok]
        apart = np.maximum(length + length[rows, best][:, None] - 2 * among[rows, best], 0)
        valid &= alpha * alpha * apart > to_node
        valid[rows, best] = False
    return out


def _side_by_side(nodes: int) -> int:
    """Searches over so many nodes that are made at once."""
    return max(1, min(STEP, MET_BYTES // (4 * max(1, nodes))))


def build(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """(graph, entry node) of distinct vectors."""
    x = lifted(vectors)
    n = len(x)
    graph = np.full((n, DEGREE + SPARE), -1, dtype=np.int32)
    middle = x.mean(axis=0)
    entry = int(np.argmin(((x - middle) ** 2).sum(axis=1)))
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    at, size = 1, 1
    while at < n:
        batch = order[at : at + size]
        for part in np.split(batch, range(_side_by_side(n), len(batch), _side_by_side(n))):
            _, went = beam_search(x, graph, entry, x[part], BUILD_BEAM, trail=True)
            graph[part, :DEGREE] = robust_prune(x, part, went, DEGREE, ALPHA)
        _link_back(x, graph, batch)
        at += len(batch)
        size = min(max(1, at), max(STEP, n // 20))
    _reach(x, graph, entry)
    return graph, entry


def _link_back(x: np.ndarray, graph: np.ndarray, batch: np.ndarray) -> None:
    """Every new link also backwards; a node with too many links is pruned."""
    to = graph[batch, :DEGREE]
    source = np.repeat(batch, DEGREE)[to.ravel() >= 0].astype(np.int32)
    target = to.ravel()[to.ravel() >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    node, start, count = np.unique(target, return_index=True, return_counts=True)
    has = (graph[node, :DEGREE] >= 0).sum(axis=1)
    fits = has + count <= DEGREE
    for i in np.flatnonzero(fits):
        new = source[start[i] : start[i] + count[i]]
        graph[node[i], has[i] : has[i] + count[i]] = new
    over = np.flatnonzero(~fits)
    over = over[np.argsort(count[over], kind="stable")]
    for i in range(0, len(over), STEP):
        part = over[i : i + STEP]
        # A hub may have got thousands of links at once: prune them in pieces that fit the proposal table.
        for first in range(0, int(count[part].max()), 2 * DEGREE):
            some = part[count[part] > first]
            take = np.minimum(count[some] - first, 2 * DEGREE)
            wide = np.full((len(some), 2 * DEGREE), -1, dtype=np.int32)
            col = np.arange(2 * DEGREE)[None, :]
            inside = col < take[:, None]
            wide[inside] = source[(start[some] + first)[:, None] + np.minimum(col, take[:, None] - 1)][inside]
            proposed = np.concatenate([graph[node[some], :DEGREE], wide], axis=1)
            graph[node[some], :DEGREE] = robust_prune(x, node[some], proposed, DEGREE, ALPHA)


def _reach(x: np.ndarray, graph: np.ndarray, entry: int) -> None:
    """Links to nodes that no path from the entry reaches."""
    n = len(x)
    reached = np.zeros(n, dtype=bool)

    def spread(front):
        while len(front):
            reached[front] = True
            out = graph[front].ravel()
            front = np.unique(out[out >= 0])
            front = front[~reached[front]]

    spread(np.array([entry]))
    while not reached.all():
        lost = int(np.flatnonzero(~reached)[0])
        spare = np.flatnonzero(reached & (graph[:, -1] < 0))
        host = int(spare[np.argmax(x[spare] @ x[lost])])
        free = DEGREE + int(np.argmax(graph[host, DEGREE:] < 0))
        graph[host, free] = lost
        spread(np.array([lost]))


# ---- spread over tasks -----------------------------------------------------------------------------------------------


def _once(ids: np.ndarray, vectors: np.ndarray):
    """Rows by id, each id once, with its smallest vector."""
    order = np.argsort(ids, kind="stable")
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.ones(len(ids), dtype=bool)
    first[1:] = ids[1:] != ids[:-1]
    return ids[first], vectors[first]


def _arrays(group: pd.DataFrame):
    return _once(group["vec_id"].to_numpy(dtype=np.int64), np.array(group["v"].tolist(), dtype=np.float64).reshape(len(group), -1))


def _indexed(group: pd.DataFrame) -> pd.DataFrame:
    ids, vectors = _arrays(group)
    node, of = np.unique(vectors, axis=0, return_inverse=True)
    length = np.sqrt((scaled(node) ** 2).sum(axis=1))
    by_length = np.argsort(length, kind="stable")
    place = np.empty(len(node), dtype=np.int64)
    place[by_length] = np.arange(len(node))
    node, of = node[by_length], place[of.ravel()]
    order = np.lexsort((ids, of))
    starts = np.searchsorted(of[order], np.arange(len(node) + 1))
    within = max(0, len(node) - max(LISTED, int((length > LONG * np.median(length)).sum())))  # the longest come last and are listed
    graph, entry = build(node[:within]) if within else (np.zeros((0, DEGREE + SPARE), dtype=np.int32), -1)
    return pd.DataFrame({"dim": [node.shape[1]], "shard": [int(group["shard"].iloc[0])], "ids": [ids[order].tobytes()], "starts": [starts.astype(np.int64).tobytes()],
                         "vectors": [node.tobytes()], "graph": [graph.tobytes()], "entry": [entry]})


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col(embedding).cast("array<double>")
    ok = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ok)


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """(graphs of all shards as a table, number of shards)."""
    bounded_batches(rows.sparkSession)
    n_shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumns({"dim": F.size("v"), "shard": F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).cast("int")})
    return store(dealt.groupBy("dim", "shard").applyInPandas(_indexed, INDEX), "ann-index"), n_shards


def search_beam(n_shards: int, k: int) -> int:
    """The beam of one shard's search: what it needs for any neighbour at all, and its share of what k need beyond that."""
    return max(LEAST_BEAM + (SEARCH_BEAM - LEAST_BEAM) // n_shards, 2 * k)


def _best(row, k: int, n_shards: int = 1):
    """Each query's k best of one of ``n_shards`` shards: rows (query id, ids, exact scores)."""
    dim = row["dim"]
    ids, starts = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["starts"], dtype=np.int64)
    vectors = np.frombuffer(row["vectors"]).reshape(-1, dim)
    graph = np.frombuffer(row["graph"], dtype=np.int32).reshape(-1, DEGREE + SPARE)
    listed = np.arange(len(graph), len(vectors))
    query_ids, queries = np.frombuffer(row["q_ids"], dtype=np.int64), np.frombuffer(row["q_vectors"]).reshape(-1, dim)
    x = scaled(vectors[: len(graph)]).astype(np.float32)
    step = _side_by_side(len(graph))
    for i in range(0, len(queries), step):
        q = queries[i : i + step]
        found = np.full((len(q), 0), -1)
        if len(graph):
            unit = q / np.abs(q).max(axis=1, keepdims=True)  # a query's own length does not change its order
            found = beam_search(x, graph, row["entry"], unit.astype(np.float32), search_beam(n_shards, k))
        for query_id, vector, nodes in zip(query_ids[i : i + step], q, found):
            nodes = np.concatenate([nodes[nodes >= 0], listed])
            score = (vectors[nodes] * vector).sum(axis=1)
            size = np.minimum(starts[nodes + 1] - starts[nodes], k + 1)  # the smallest ids of a node are enough
            who = ids[np.repeat(starts[nodes] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            score = np.repeat(score, size)
            score, who = score[who != query_id], who[who != query_id]
            order = np.lexsort((who, -score))[:k]
            yield int(query_id), who[order].tolist(), score[order].tolist()


def search(graphs: DataFrame, n_shards: int, queries: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each of ``queries`` (vec_id, v) but itself."""
    bounded_batches(queries.sparkSession)
    n_blocks = max(1, -(-queries.count() // block_rows))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = _arrays(group)
        return pd.DataFrame({"dim": [vectors.shape[1]], "q_ids": [ids.tobytes()], "q_vectors": [vectors.tobytes()]})

    def run(batches):
        for b in batches:
            for _, row in b.iterrows():
                yield pd.DataFrame(list(_best(row, k, n_shards)), columns=["query_id", "ids", "scores"])

    blocks = queries.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(n_blocks))})
    blocks = blocks.groupBy("dim", "block").applyInPandas(pack, "dim int, q_ids binary, q_vectors binary")
    blocks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    met = blocks.join(graphs, ["dim", "shard"])
    found = met.mapInPandas(run, "query_id long, ids array<long>, scores array<double>")
    pairs = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("p"))
    pairs = pairs.select("query_id", F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k nearest rows of each row whose id is divisible by ``every``."""
    rows = store(usable(vectors), "ann-rows")
    graphs, n_shards = index(rows, shard_rows)
    return search(graphs, n_shards, rows.filter(F.col("vec_id") % every == 0), k)
