"""Hard-negative mining by an inverted multi-index.

Score: the inner product of integer vectors floor(256 x).  An anchor's
positives are its best rows of the same label; for each positive, the best
rows of other labels whose score lies in the window
[low % of the positive's score, high % of it] are its hard negatives.

Index: vectors are cut into two halves, each half-space has a codebook
(k-means on a bounded sample of ``SAMPLE`` rows; every row is indexed), and a
pair of entries is a cell.  For a query, a half's bound for an entry is the inner product with
it plus the query's length times the entry's radius (the largest
distance of a member to it), so the sum of two half bounds is above every score in
the cell.  Both lists of half bounds are sorted and a heap visits the
cells in the order of their sums (multi-sequence).  The visit stops when
the next sum is below what any window still needs: the worst of its wanted
number of rows, or its lower end.  The results are therefore exact; no cell or
candidate count is capped.

Spark: rows are dealt evenly to shards of at most ``SHARD_ROWS`` rows by a hash, so
neither a label nor a cell with a third of the rows makes one task large.
A task sorts its shard's rows by cell and streams the queries past them.
Two passes: positives first, merged over the shards, then the windows they
give.  The shuffle carries every row once and every anchor once for each
shard (``SHARD_ROWS`` sets that number; a shard's rows must fit a
worker's memory, 16 bytes a component); of the results at most the wanted number for each
anchor, window and shard.  The codebooks are the only broadcast, of a fixed size.

Defined results: rows with a null id or label, a null vector, a null, NaN
or infinite component, or a squared integer length of 2**60 or more take
no part, nor do vectors of another length than that of the smallest id
(an odd length has halves of unequal size).  Repeated ids are rows of
their own; an anchor is never its own positive, but another row with its
id can be.  Ties go to the smaller id.  A negative score has an empty window.
An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, store
from .vectors import common_length, integers, taking_part

SAMPLE = 20_000  # rows that fit the codebooks
SHARD_ROWS = 1 << 18
LEAST_ROWS = 2048  # a smaller shard is not worth a task
CELL_ROWS = 32  # rows in a cell, on average, that the codebooks' size aims at
MOST_ENTRIES = 64
LOOK = 512  # rows scored at once while cells are visited


def _means(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spread points of the lexicographic order; empty entries stay."""
    points = points[np.lexsort(points.T[::-1])]
    book = points[np.linspace(0, len(points) - 1, k).astype(int)].astype(np.float64)
    for _ in range(rounds):
        near = _nearest(points, book)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(book)
        np.add.at(total, near, points)
        book[n > 0] = total[n > 0] / n[n > 0, None]
    return book


def _nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book**2).sum(axis=1) - 2.0 * (points.astype(np.float64) @ book.T)).argmin(axis=1)


class Cells:
    """A shard's rows in the order of their cells."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, codes: np.ndarray, books: list[np.ndarray]):
        order = np.lexsort((codes[:, 1], codes[:, 0]))
        self.vectors, self.ids, self.labels, self.rows = vectors[order], ids[order], labels[order], rows[order]
        self.codes, self.books = codes[order], books
        self.half = books[0].shape[1]
        self.radius = []
        for h, v in enumerate((self.vectors[:, : self.half], self.vectors[:, self.half :])):
            away = np.sqrt(((v - books[h][self.codes[:, h]]) ** 2).sum(axis=1))
            radius = np.full(len(books[h]), -np.inf)
            np.maximum.at(radius, self.codes[:, h], away)
            self.radius.append(radius)
        self.length = math.sqrt(float((self.vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)))
        self.as_float = self.vectors.astype(np.float64)
        self.of_label: dict[int | None, tuple[np.ndarray, dict[int, tuple[int, int]]]] = {}

    def members(self, label: int | None) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
        """Places of the label's rows (None: all) in the order of the cells, and each cell's part of them."""
        if label not in self.of_label:
            mine = np.arange(len(self.ids)) if label is None else np.flatnonzero(self.labels == label)
            cell = self.codes[mine, 0] * len(self.books[1]) + self.codes[mine, 1]
            heads = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[: len(mine)])
            ends = np.append(heads[1:], len(mine))
            self.of_label[label] = mine, {c: (a, b) for c, a, b in zip(cell[heads].tolist(), heads.tolist(), ends.tolist())}
        return self.of_label[label]

    def scores(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        if math.sqrt(float((query.astype(np.float64) ** 2).sum())) * self.length < 2**52:
            return (self.as_float[places] @ query).astype(np.int64)  # exact: no partial sum leaves 2**53
        return self.vectors[places] @ query

    def visit(self, query: np.ndarray, label: int | None = None):
        """(places, bound of all that is left) of the label's cells, best bound first, at least ``LOOK`` rows at a time."""
        mine, span = self.members(label)
        if not len(mine):
            return
        k2, lengths, bounds, orders = len(self.books[1]), [], [], []
        for h, q in enumerate((query[: self.half], query[self.half :])):
            used = np.isfinite(self.radius[h])
            lengths.append(math.sqrt(float((q.astype(np.float64) ** 2).sum())))
            b = np.where(used, self.books[h] @ q + lengths[h] * np.where(used, self.radius[h], 0.0), -np.inf)
            orders.append(np.argsort(-b, kind="stable"))
            bounds.append(b[orders[h]])
        (b1, b2), (o1, o2) = bounds, orders
        slack = 1.0 + 1e-9 * (sum(lengths) * max(1.0, self.length) + abs(float(b1[0])) + abs(float(b2[0])))  # rounding in the bounds
        heap = [(-(b1[0] + b2[0]), 0, 0)]
        held, size = [], 0
        while heap:
            bound, x, y = heapq.heappop(heap)
            if bound == np.inf:  # an entry without rows, and so are all that follow
                break
            if y == 0 and x + 1 < len(b1):
                heapq.heappush(heap, (-(b1[x + 1] + b2[0]), x + 1, 0))
            if y + 1 < len(b2):
                heapq.heappush(heap, (-(b1[x] + b2[y + 1]), x, y + 1))
            at = span.get(int(o1[x]) * k2 + int(o2[y]))
            if at is None:
                continue
            held.append(mine[at[0] : at[1]])
            size += at[1] - at[0]
            if size >= LOOK:
                yield np.concatenate(held), (-heap[0][0] + slack if heap else -np.inf)
                held, size = [], 0
        if held:
            yield np.concatenate(held), -np.inf

    def best(self, query: np.ndarray, own: int, label: int, windows: list[tuple[float, float]], count: int, same: bool):
        """For each window (low, high): places and scores of its ``count`` best rows of the same label, or of others."""
        found = [(np.zeros(0, dtype=int), np.zeros(0, dtype=np.int64)) for _ in windows]
        need = [low for low, _ in windows]  # a score below it cannot enter the window's result any more
        for places, left in self.visit(query, label if same else None):
            places = places[self.rows[places] != own] if same else places[self.labels[places] != label]
            scores = self.scores(query, places)
            for i, (low, high) in enumerate(windows):
                fits = np.flatnonzero((scores >= need[i]) & (scores <= high))
                if not len(fits):
                    continue
                p, s = np.concatenate([found[i][0], places[fits]]), np.concatenate([found[i][1], scores[fits]])
                first = np.lexsort((self.rows[p], self.ids[p], -s))[:count]
                found[i] = p[first], s[first]
                if len(first) == count:
                    need[i] = int(s[first[-1]])
            if left < min(need):
                break
        return found


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, list[np.ndarray], int]:
    """Stored rows (shard, row, vec_id, label, c1, c2, vec) with their cells, the two codebooks and the number of shards."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    known = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    length = common_length(known)
    kept = taking_part(known, length)
    n = kept.count() if length else 0
    tasks = spark.sparkContext.defaultParallelism
    shards = max(1, -(-n // shard_rows), min(tasks, -(-n // LEAST_ROWS)))
    half = (length + 1) // 2
    k = max(1, min(MOST_ENTRIES, round(math.sqrt(n / shards / CELL_ROWS))))
    if n:
        share = min(1.0, 2 * SAMPLE / n)
        order = F.xxhash64("vec_id", F.lit("sample"))
        cut = order <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))
        some = kept.filter(cut).orderBy(order, "vec_id", "embedding").limit(SAMPLE).select("embedding").toPandas()["embedding"]
        points = np.floor(256 * np.array([np.asarray(v, dtype=np.float64) for v in some])) if len(some) else np.zeros((1, length))
        books = [_means(points[:, :half], k), _means(points[:, half:], k)]
    else:
        books = [np.zeros((1, half)), np.zeros((1, length - half))]
    held = spark.sparkContext.broadcast(books)

    def cells(batches):
        books = held.value
        for b in batches:
            if not len(b):
                continue
            v = integers(b.column(2))
            c1, c2 = _nearest(v[:, :half], books[0]), _nearest(v[:, half:], books[1])
            vec = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * length, pa.int32()), pa.array(v.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(c1.astype(np.int32)), pa.array(c2.astype(np.int32)), vec], ["vec_id", "label", "c1", "c2", "vec"])

    plain = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    made = plain.mapInArrow(cells, "vec_id long, label long, c1 int, c2 int, vec array<int>") if length else spark.createDataFrame([], "vec_id long, label long, c1 int, c2 int, vec array<int>")
    made = made.withColumn("row", F.monotonically_increasing_id())
    made = store(made.withColumn("shard", F.pmod(F.xxhash64("vec_id", "row"), F.lit(shards)).cast("int")), "hardneg-index")
    return made, books, shards


def _search(rows: DataFrame, books: list[np.ndarray], shards: int, queries: DataFrame, count: int, same: bool) -> DataFrame:
    """anchor (row), of (the window's score), row, vec_id, score: each shard's best for each query row (row, vec_id, label, vec, windows)."""
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(books)
    columns = ["shard", "kind", "row", "vec_id", "label", "c1", "c2", "vec", "windows"]
    none = F.lit(None)
    stored = rows.withColumns({"kind": F.lit(0), "windows": none.cast("array<struct<of:long,low:long,high:long>>")}).select(*columns)
    asked = queries.withColumns({"kind": F.lit(1), "c1": none.cast("int"), "c2": none.cast("int"),
                                 "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))}).select(*columns)
    dealt = stored.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")

    def search(batches):
        books, parts, cells, at, out = held.value, [], None, None, []
        for b in batches:
            shard, kind = b.column("shard").to_numpy(), b.column("kind").to_numpy()
            for key in dict.fromkeys(zip(shard.tolist(), kind.tolist())):
                mine = np.flatnonzero((shard == key[0]) & (kind == key[1]))
                part = b.slice(int(mine[0]), len(mine))  # rows of a key stand together
                if key[1] == 0:
                    if at != key[0]:
                        parts, cells, at = [], None, key[0]
                    parts.append(part)
                    continue
                if at != key[0]:
                    continue  # a shard without rows
                if cells is None:
                    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    parts = []
                    column = lambda c: whole.column(c).to_numpy(zero_copy_only=False)  # noqa: E731, B023
                    vec = whole.column("vec").flatten().to_numpy().astype(np.int64).reshape(len(whole), -1)
                    cells = Cells(vec, column("vec_id"), column("label"), column("row"), np.column_stack([column("c1"), column("c2")]).astype(np.int64), books)
                    del whole, vec
                asked = part.select(["row", "label", "vec", "windows"])
                for q in (q for i in range(0, len(asked), 256) for q in asked.slice(i, 256).to_pylist()):
                    windows = q["windows"] or [{"of": None, "low": -math.inf, "high": math.inf}]
                    got = cells.best(np.array(q["vec"], dtype=np.int64), q["row"], q["label"], [(w["low"], w["high"]) for w in windows], count, same)
                    for w, (p, s) in zip(windows, got):
                        out += [(q["row"], w["of"], r, i, v) for r, i, v in zip(cells.rows[p].tolist(), cells.ids[p].tolist(), s.tolist())]
                    if len(out) > 1 << 14:
                        yield _batch(out)
                        out = []
        if out:
            yield _batch(out)

    return dealt.mapInArrow(search, "anchor long, of long, row long, vec_id long, score long")


def _batch(out: list[tuple]) -> pa.RecordBatch:
    names = ["anchor", "of", "row", "vec_id", "score"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)


def mine(vectors: DataFrame, anchors, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where the Column ``anchors`` holds.

    ``vectors``: vec_id, label (whole numbers), embedding.  A negative's
    score n and its positive's score p satisfy low * p <= 100 * n <= high * p.
    """
    rows, books, shards = index(vectors, shard_rows)
    asked = rows.filter(anchors).select("row", "vec_id", "label", "vec")
    order = [F.col("score").desc(), F.col("vec_id").asc(), F.col("row").asc()]
    everything = F.lit(None).cast("array<struct<of:long,low:long,high:long>>")
    near = _search(rows, books, shards, asked.withColumn("windows", everything), positives, same=True)
    rank = F.row_number().over(W.partitionBy("anchor").orderBy(*order))
    kept = store(near.withColumn("rank", rank).filter(F.col("rank") <= positives).select("anchor", "score", "vec_id", "row"), "hardneg-positives")

    p = F.col("score").cast("decimal(20,0)")
    window = F.struct(F.col("score").alias("of"), F.ceil(p * low / 100).cast("long").alias("low"), F.floor(p * high / 100).cast("long").alias("high"))
    spans = kept.select("anchor", window.alias("w")).filter("w.low <= w.high").groupBy("anchor").agg(F.collect_set("w").alias("windows"))
    found = _search(rows, books, shards, asked.join(spans, asked["row"] == F.col("anchor")).drop("anchor"), negatives, same=False)
    rank = F.row_number().over(W.partitionBy("anchor", "of").orderBy(*order))
    found = found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    found = found.select("anchor", "rank", F.col("of").alias("positive_score"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = kept.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = rows.filter(anchors).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(pairs, ["anchor", "positive_score"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """WITH kept AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding]::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5"""
