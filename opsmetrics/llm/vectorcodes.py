"""Vector code compression: product codes by a lexicographic trie over distinct parts.

Vectors of integers floor(256 x) are cut into equal consecutive parts;
each part position has a codebook of a few entries, first the parts of the
vectors with the smallest ids, then moved by rounds of assignment and
averaging (componentwise floor of the mean; unused entries stay).

Assignment: the distinct parts of a position are sorted, which makes them
a trie with one level for each component.  A depth-first walk carries the
distances from the components so far to all entries and adds one
component's share on each edge, so parts with a common prefix share the
work done for it.  A leaf takes the nearest entry (ties to the lower
index) and adds its part, times the number of its copies, to that entry's
sums.  Below a node with few leaves the walk goes on for all of them side
by side, still once for each distinct prefix.

Spark: a round is one pass over the vectors without a shuffle of vectors;
a task builds its tries over ``vectors.CHUNK_ROWS`` vectors at a time and
gives out sums for each (position, entry), a number of rows that the codebooks
bound.  The codebooks (positions x entries x width integers) are the only
thing that is sent to the tasks.  ``compress`` reads its input
``rounds + 2`` times: store it first if it is costly to make.

Defined results: vectors that are null, hold a null, NaN or infinite
component, or whose squared integer length reaches 2**60 take no part, nor
do those of another length than the common one (that of the smallest id
whose length is a positive multiple of the number of parts).  Fewer vectors
than entries give smaller codebooks.  Repeated ids are vectors of their
own, equal ids ordered by their components; null ids come last.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches
from .vectors import chunks, common_length, integers, taking_part

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SIDE_BY_SIDE = 4096  # leaves below a node that are walked at once
LABELS = 100_000  # label totals up to this number are sent to all tasks, more are joined by a shuffle


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, each row's place among them, and their copies."""
    low = parts.min(axis=0)
    span = [int(x) + 1 for x in parts.max(axis=0) - low]
    size = 1
    for s in span:
        size *= s
    if size >= 1 << 62:
        rows, place, copies = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
        return rows, place.reshape(-1), copies
    key = np.zeros(len(parts), dtype=np.int64)
    for j, s in enumerate(span):
        key = key * s + (parts[:, j] - low[j])
    _, first, place, copies = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return parts[first], place, copies


def walk(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and its squared distance for sorted distinct ``rows``, by a depth-first walk of their trie."""
    n, width = rows.shape
    nearest, distance = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    stack = [(0, n, 0, np.zeros(len(book), dtype=np.int64))]
    while stack:
        lo, hi, depth, so_far = stack.pop()
        if hi - lo > SIDE_BY_SIDE and depth < width:
            values = rows[lo:hi, depth]
            heads = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
            shares = so_far + (values[heads][:, None] - book[:, depth]) ** 2
            ends = np.append(heads[1:], hi - lo)
            stack += [(lo + a, lo + b, depth + 1, share) for a, b, share in zip(heads[::-1].tolist(), ends[::-1].tolist(), shares[::-1])]
            continue
        node, carried = np.zeros(hi - lo, dtype=np.int64), so_far[None, :]
        starts = np.zeros(hi - lo, dtype=bool)
        starts[:1] = True
        for j in range(depth, width):
            values = rows[lo:hi, j]
            starts[1:] |= values[1:] != values[:-1]
            heads = np.flatnonzero(starts)
            carried = carried[node[heads]] + (values[heads][:, None] - book[:, j]) ** 2
            node = np.cumsum(starts) - 1
        best = carried.argmin(axis=1)  # the first of equal ones
        nearest[lo:hi] = best[node]
        distance[lo:hi] = carried[np.arange(len(best)), best][node]
    return nearest, distance


def _kept(vectors: DataFrame, parts: int) -> tuple[DataFrame, int]:
    length = common_length(vectors, multiple=parts)
    return taking_part(vectors, length), length


def _first_books(kept: DataFrame, length: int, parts: int, entries: int) -> np.ndarray:
    """(parts, entries, width) from the vectors of the smallest ids."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    first = np.floor(256 * np.array([r["embedding"] for r in rows], dtype=np.float64)).astype(np.int64)
    return first.reshape(len(rows), parts, length // parts).transpose(1, 0, 2)


def _moved(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round of assignment and averaging."""
    parts, entries, width = books.shape
    held = kept.sparkSession.sparkContext.broadcast(books)

    def sums(batches):
        books = held.value
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)  # last: the number of parts
        for batch in chunks(batches):
            whole = integers(batch.column(0))
            for p in range(parts):
                rows, _, copies = distinct_parts(whole[:, p * width : (p + 1) * width])
                nearest, _ = walk(rows, books[p])
                np.add.at(total[p], nearest, np.column_stack([rows * copies[:, None], copies]))
        p, e = np.nonzero(total[:, :, width])
        if len(p):
            at = np.arange(width + 1)
            columns = [np.repeat(p, width + 1), np.repeat(e, width + 1), np.tile(at, len(p)), total[p, e].ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "at", "total"])

    found = kept.select("embedding").mapInArrow(sums, "part long, entry long, at long, total long")
    rows = found.groupBy("part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {(r["part"], r["entry"], r["at"]): int(r["total"]) for r in rows}
    moved = books.copy()
    for (p, e, at), value in total.items():
        if at < width:
            moved[p, e, at] = value // total[p, e, width]
    return moved


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts, entries, width) of ``vectors`` (vec_id, embedding); None if no vector takes part."""
    bounded_batches(vectors.sparkSession)
    kept, length = _kept(vectors, parts)
    if not length:
        return None
    books = _first_books(kept, length, parts, entries)
    for _ in range(rounds):
        books = _moved(kept, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray | None) -> DataFrame:
    """vec_id, label, code (two hex digits for each part), error (squared distance to the coded vector) of the vectors that take part."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    ids = [vectors.schema["vec_id"], vectors.schema["label"]]
    schema = T.StructType([*ids, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if books is None:
        return spark.createDataFrame([], schema)
    parts, _, width = books.shape
    held = spark.sparkContext.broadcast(books)

    def codes(batches):
        books = held.value
        for batch in chunks(batches):
            whole = integers(batch.column(2))
            code = np.zeros((len(whole), parts), dtype=np.uint8)
            error = np.zeros(len(whole), dtype=np.int64)
            for p in range(parts):
                rows, place, _ = distinct_parts(whole[:, p * width : (p + 1) * width])
                nearest, distance = walk(rows, books[p])
                code[:, p] = nearest[place]
                error += distance[place]
            text = pa.array([bytes(c).hex() for c in code], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text, pa.array(error)], ["vec_id", "label", "code", "error"])

    return taking_part(vectors, parts * width).select("vec_id", "label", "embedding").mapInArrow(codes, schema)


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([books[p, e] for p, e in enumerate(bytes.fromhex(code))])


def books_sha256(books: np.ndarray | None) -> str:
    text = "" if books is None else ",".join(map(str, books.ravel().tolist()))
    return hashlib.sha256(text.encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` (stored) with label_error, the error summed over equal labels, nulls together (null if it fits no long)."""
    totals = coded.groupBy(F.col("label").alias("__label")).agg(F.try_sum("error").alias("label_error"))
    if totals.count() <= LABELS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def _oracle() -> str:
    d = ", ".join(f"v[4 * p + {j + 1}] AS c{j}" for j in range(4))
    dist = " + ".join(f"(x.c{j} - b.c{j}) * (x.c{j} - b.c{j})" for j in range(4))
    mean = ", ".join(f"COALESCE((s.s{j} - ((s.s{j} % s.n) + s.n) % s.n) // s.n, b.c{j}) AS c{j}" for j in range(4))
    steps = []
    for r in range(ROUNDS):
        steps.append(f"""near{r} AS (SELECT x.vec_id, x.p, MIN(({dist}) * 64 + b.e) % 64 AS e FROM parts x JOIN book{r} b ON b.p = x.p GROUP BY 1, 2),
sums{r} AS (SELECT x.p, m.e, COUNT(*) AS n, {', '.join(f'SUM(x.c{j})::BIGINT AS s{j}' for j in range(4))}
  FROM parts x JOIN near{r} m ON m.vec_id = x.vec_id AND m.p = x.p GROUP BY 1, 2),
book{r + 1} AS (SELECT b.p, b.e, {mean} FROM book{r} b LEFT JOIN sums{r} s ON s.p = b.p AND s.e = b.e)""")
    last = f"book{ROUNDS}"
    return f"""WITH kept AS (SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (SELECT vec_id, p, {d} FROM kept, range(16) t(p)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT x.p, s.e, x.c0, x.c1, x.c2, x.c3 FROM seeds s JOIN parts x ON x.vec_id = s.vec_id),
{', '.join(steps)},
best AS (SELECT x.vec_id, x.p, MIN(({dist}) * 64 + b.e) AS m FROM parts x JOIN {last} b ON b.p = x.p GROUP BY 1, 2),
coded AS (SELECT vec_id, string_agg(printf('%02x', m % 64), '' ORDER BY p) AS code, SUM(m // 64)::BIGINT AS error FROM best GROUP BY vec_id),
sha AS (SELECT sha256(string_agg(concat_ws(',', c0, c1, c2, c3), ',' ORDER BY p, e)) AS codebooks_sha256 FROM {last})
SELECT k.vec_id, c.code, c.error, (SUM(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, sha.codebooks_sha256
FROM kept k JOIN coded c ON c.vec_id = k.vec_id, sha"""


ORACLE = _oracle()
