"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts anywhere else.

Method (``bwt``): strings are dealt into shards, each shard has its
Burrows-Wheeler transform, and the transforms are merged by iterative interleave
refinement; the blocks left after ``length`` bytes are the repeated intervals.

Spark: one transform of everything would be one task's work, so the texts'
windows (the strings of ``length`` bytes) are first dealt out by content.
A window's key is the smallest hash of its strings of ``k`` bytes; equal windows have equal keys, and
neighbouring windows mostly share theirs, so a text is cut into runs of
windows with one key.  Only runs whose key occurs twice anywhere can hold
a repeat; the bytes of these runs (pieces) go to their key's task, equal pieces
once, with their number.  There they are split into shards, transformed and merged.
All windows of a key meet in one task; a key with more than ``HOT_BYTES`` of
distinct pieces is dealt again by the windows' smallest hash of more bytes, in the end of
all ``length`` bytes, where a key has one piece.  Nothing is capped or left out.

The shuffles carry 16 to 40 bytes for each run (about one for 70 bytes of
text), the distinct pieces of repeated keys, and the texts twice (to meet their
runs, and their repeated spans).  Python workers hold one bucket of ``BUCKET_BYTES`` of pieces or
``SEGMENT`` bytes of text at a time.  Texts and pieces are known by digests of 128 bits or more; equality
of windows is decided by the transforms' symbols, never by their keys.

Defined results: a null text is the empty text; a text under ``length``
bytes has no windows and stays whole.  Windows never cross texts.  Copies of a text are
separate texts, so all their windows repeat.  Rows keep their other columns; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bwt import Transform, merge
from .common import bounded_batches, store

LENGTH = 200
SEGMENT = 1 << 17  # bytes whose hashes are worked out at once: few enough for the processor's cache
RUN = 4096  # windows in a run at most; longer ones (periodic texts) are cut
HOT_BYTES = 1 << 21
TASK_BYTES = 1 << 20
BUCKET_BYTES = 1 << 18  # merged at once, as are shards transformed: arrays over them stay in the processor's cache
SHARD_BYTES = 1 << 16
LEAST_BYTES = 1 << 18  # of pieces that are worth a task
SEEN = 1 << 18  # pieces whose bytes a task remembers to have given out
OUT_BYTES = 1 << 22
SPANS = "array<struct<at:int,n:int>>"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def key_bytes(length: int) -> list[int]:
    """Bytes under the key's hash: a third of a window at first, all of it in the end."""
    return sorted({max(1, length * part // 25) for part in (8, 16, 22, 25)})


# ---- keys of windows -------------------------------------------------------------------------------------------------


@lru_cache(maxsize=64)
def _powers(base: int, n: int) -> np.ndarray:
    """base, base**2 and so on."""
    return np.cumprod(np.full(n, base, dtype=np.uint64))


def _hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of each string of ``k`` bytes."""
    n = len(data)
    room = 1 << n.bit_length()  # so that few lengths are worked out
    total = np.zeros(n + 1, dtype=np.uint64)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    values *= _powers(_BASE, room)[:n]
    np.cumsum(values, out=total[1:])
    h = total[k:] - total[:-k]
    h *= _powers(_INVERSE, room)[: n - k + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _slide(best, values: np.ndarray, w: int, worst: int) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``w`` neighbouring values."""
    m = len(values) - w + 1
    rows = np.concatenate((values, np.full(-len(values) % w, worst, dtype=np.uint64))).reshape(-1, w)
    ahead, behind = best.accumulate(rows, axis=1).ravel(), best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:m], ahead[w - 1 : w - 1 + m])


def runs(data: np.ndarray, first: np.ndarray, size: np.ndarray, k: int, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one key, in texts that stand one after another in ``data``: text, start, n, key, twice.

    ``twice``: the key's string stands more than once in the run, as it
    must where a window repeats within the run.
    """
    w = length - k + 1
    if len(data) < length or not (size >= length).any():
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, bool))
    h = _hashes(data, k)
    key = _slide(np.minimum, h, w, (1 << 64) - 1)
    has = size >= length
    starts, last = first[has], (first + size - length)[has]
    edge = np.zeros(len(key) + 1, dtype=np.int8)
    np.add.at(edge, starts, 1)
    np.add.at(edge, last + 1, -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    head = np.concatenate(([True], key[1:] != key[:-1]))
    head[starts] = True
    at = np.flatnonzero(head & inside)
    text = np.searchsorted(starts, at, side="right") - 1
    n = np.minimum(np.append(at[1:], len(key)), last[text] + 1) - at
    # Strings that are the key of some window, next to an equal one.
    edges = np.zeros(w - 1, dtype=np.uint64)
    of = _slide(np.maximum, np.concatenate((edges, np.where(inside, key, np.uint64(0)), edges)), w, 0)
    chosen = np.flatnonzero(of == h)
    near = chosen[:-1][(h[chosen[1:]] == h[chosen[:-1]]) & (np.diff(chosen) <= w)]
    near = near[near < len(key)]
    twice = np.zeros(len(at), dtype=bool)
    twice[np.searchsorted(at, near[inside[near]], side="right") - 1] = True
    cuts = -(-n // RUN)
    which = np.repeat(np.arange(len(at)), cuts)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    n = np.minimum(n[which] - nth * RUN, RUN)
    return np.flatnonzero(has)[text[which]], at[which] + nth * RUN - starts[text[which]], n, key[at[which]], twice[which]


def _text_runs(column: pa.Array, k: int, length: int):
    """(text, start, n, key, twice) over a batch of texts, ``SEGMENT`` bytes at a time, cut the same way wherever a text stands."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    found, i = [], 0
    while i < len(column):
        a = int(offsets[i])
        j = max(i + 1, int(np.searchsorted(offsets, a + SEGMENT, side="right")) - 1)
        b = int(offsets[j])
        if j > i + 1 or b - a <= SEGMENT:
            text, *rest = runs(data[a:b], offsets[i:j] - a, np.diff(offsets[i : j + 1]), k, length)
            found.append((text + i, *rest))
        else:
            for s in range(a, b - length + 1, SEGMENT):
                part = data[s : min(b, s + SEGMENT + length - 1)]
                text, start, *rest = runs(part, np.zeros(1, dtype=np.int64), np.array([len(part)]), k, length)
                found.append((text + i, start + (s - a), *rest))
        i = j
    return [np.concatenate(c) for c in zip(*found)] if found else None


def _runs_by_text(texts: DataFrame, k: int, length: int) -> DataFrame:
    """sid, copies, runs (array of start, n, key; n is negative where the run holds its key twice), one row for each distinct text."""

    def cut(batches):
        for b in batches:
            found = _text_runs(b.column("text"), k, length)
            if found is None:
                continue
            text, start, n, key, twice = found
            ends = np.searchsorted(text, np.arange(len(b) + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays([
                pa.array(start.astype(np.int32)), pa.array(np.where(twice, -n, n).astype(np.int32)), pa.array(key.view(np.int64))], ["start", "n", "key"])
            out = pa.RecordBatch.from_arrays([b.column("sid"), b.column("copies"), pa.ListArray.from_arrays(pa.array(ends), items)], ["sid", "copies", "runs"])
            yield out.filter(pa.array(np.diff(ends) > 0))

    made = texts.mapInArrow(cut, "sid binary, copies long, runs array<struct<start:int,n:int,key:long>>")
    return made.groupBy("sid").agg(F.sum("copies").alias("copies"), F.any_value("runs").alias("runs"))


def _pieces(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """sid, start, key, pid, copies of the wanted runs, and the piece's bytes (null where the task gave them out before)."""

    def cut(batches):
        seen, rows, size = set(), [], 0
        for b in batches:
            for sid, text, copies, list_ in zip(*(b.column(c).to_pylist() for c in ("sid", "text", "copies", "runs"))):
                for r in list_:
                    piece = text[r["start"] : r["start"] + abs(r["n"]) + length - 1]
                    pid = blake2b(piece, digest_size=16).digest()
                    if pid in seen:
                        piece = None
                    else:
                        seen.add(pid)
                        size += len(piece)
                        if len(seen) > SEEN:
                            seen = set()
                    rows.append((sid, r["start"], r["key"], pid, copies, piece))
                    if size > OUT_BYTES or len(rows) > 1 << 14:
                        yield _rows(rows)
                        rows, size = [], 0
        if rows:
            yield _rows(rows)

    def _rows(rows):
        kinds = [pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["sid", "start", "key", "pid", "copies", "piece"])

    once = texts.groupBy("sid").agg(F.any_value("text").alias("text"), F.sum("copies").alias("copies"))  # copies meet before the shuffle
    met = once.join(wanted, "sid").select("sid", "text", "copies", "runs")
    return met.mapInArrow(cut, "sid binary, start int, key long, pid binary, copies long, piece binary")


# ---- repeated windows of pieces --------------------------------------------------------------------------------------


def repeated(strings: list[bytes], copies: list[int], length: int, shard_bytes: int = SHARD_BYTES) -> list[list[tuple[int, int]]]:
    """For each distinct string the (start, n) of its neighbouring windows that occur at least twice."""
    shards, held, size = [], [], 0
    for i, s in enumerate(strings):
        held.append(i)
        size += len(s)
        if size >= shard_bytes or i + 1 == len(strings):
            shards.append(held)
            held, size = [], 0
    transforms = [Transform([strings[i] for i in s], [copies[i] for i in s], length) for s in shards]
    found: list[list[tuple[int, int]]] = [[] for _ in strings]
    for ids, (string, offset, _) in zip(shards, merge(transforms, length)):
        order = np.lexsort((offset, string))
        string, offset = string[order], offset[order]
        heads = np.flatnonzero(np.concatenate(([True], (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)))) if len(string) else []
        for a, b in zip(heads, np.append(heads[1:], len(string))):
            found[ids[string[a]]].append((int(offset[a]), int(b - a)))
    return found


def _repeated_in(pieces: DataFrame, length: int, tasks: int) -> DataFrame:
    """sid (the piece's), spans of repeated windows; ``pieces``: key, pid, piece, copies, distinct."""

    def search(batches):
        held, size, last = [], 0, None
        for b in batches:
            for key, pid, piece, copies in zip(*(b.column(c).to_pylist() for c in ("key", "pid", "piece", "copies"))):
                if size >= BUCKET_BYTES and key != last:  # a key's pieces stay together
                    yield from flush(held)
                    held, size = [], 0
                held.append((pid, piece, copies))
                size += len(piece)
                last = key
        yield from flush(held)

    def flush(held):
        if not held:
            return
        found = repeated([p for _, p, _ in held], [c for *_, c in held], length)
        rows = [(pid, [{"at": a, "n": n} for a, n in spans]) for (pid, *_), spans in zip(held, found) if spans]
        if rows:
            kinds = [pa.binary(), pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["sid", "spans"])

    dealt = pieces.select("key", "pid", "piece", "copies").repartition(tasks, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(search, f"sid binary, spans {SPANS}")


def _spans(texts: DataFrame, length: int, keys: list[int]) -> DataFrame:
    """sid, spans: the repeated windows of ``texts`` (sid, text, copies), as starts and numbers of neighbours."""
    spark = texts.sparkSession
    k, *longer = keys
    by_text = store(_runs_by_text(texts, k, length), "repeats-runs", "zstd")
    each = by_text.select("sid", "copies", F.explode("runs").alias("r"))
    weight = F.when((F.col("copies") > 1) | (F.col("r.n") < 0), 2).otherwise(1)
    counts = each.groupBy(F.col("r.key").alias("key")).agg(F.sum(weight).alias("n"))
    counts = store(counts.filter("n > 1").select("key"), "repeats-keys")
    wanted = each.select("sid", "r.start", "r.n", "r.key").join(counts, "key")
    wanted = store(wanted.groupBy("sid").agg(F.collect_list(F.struct("start", "n", "key")).alias("runs")), "repeats-wanted", "zstd")
    pieces = store(_pieces(texts, wanted, length), "repeats-pieces", "zstd")
    distinct = pieces.groupBy("key", "pid").agg(F.sum("copies").alias("copies"), F.any_value("piece", True).alias("piece"))
    distinct = store(distinct, "repeats-distinct", "zstd")
    sizes = distinct.groupBy("key").agg(F.sum(F.length("piece")).alias("size"))
    hot = store(sizes.filter(F.col("size") > HOT_BYTES).select("key"), "repeats-hot") if longer else None
    all_bytes, hot_keys = distinct.agg(F.sum(F.length("piece"))).first()[0] or 0, hot.count() if longer else 0
    plain = distinct.join(hot, "key", "left_anti") if hot_keys else distinct
    tasks = max(-(-all_bytes // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-all_bytes // LEAST_BYTES)), 1)
    found = store(_repeated_in(plain, length, tasks), "repeats-found")
    if hot_keys:
        again = distinct.join(hot, "key", "left_semi").select(F.col("pid").alias("sid"), F.col("piece").alias("text"), "copies")
        found = found.unionByName(_spans(store(again, "repeats-again"), length, longer))
    shifted = F.transform("spans", lambda s: F.struct((s["at"] + F.col("start")).alias("at"), s["n"].alias("n")))
    placed = pieces.select("sid", "start", "pid").join(found.withColumnRenamed("sid", "pid"), "pid").select("sid", shifted.alias("spans"))
    return store(placed.groupBy("sid").agg(_joined(F.flatten(F.collect_list("spans"))).alias("spans")), "repeats-spans")


def _joined(spans: Column) -> Column:
    """Spans in order, neighbours as one."""
    end = lambda s: s["at"] + s["n"]
    last = lambda a: F.element_at(a, -1)
    longer = lambda a, s: F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last(a)["at"].alias("at"), (last(a)["n"] + s["n"]).alias("n"))))
    step = lambda a, s: F.when((F.size(a) > 0) & (end(F.get(a, F.size(a) - 1)) == s["at"]), longer(a, s)).otherwise(F.concat(a, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), step)


def _cover(spans, length: int) -> list[tuple[int, int]]:
    """The maximal byte ranges [start, stop) that the windows cover."""
    out: list[list[int]] = []
    for a, b in sorted((s["at"], s["at"] + s["n"] - 1 + length) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(length: int):
    @F.pandas_udf("removed array<struct<start:int,stop:int>>, kept binary")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        removed, kept = [], []
        for text, s in zip(texts, spans):
            ranges = _cover(s, length) if s is not None else []
            at, parts = 0, []
            for a, b in ranges:
                parts.append(text[at:a])
                at = b
            removed.append([{"start": a, "stop": b} for a, b in ranges])
            kept.append(b"".join([*parts, text[at:]]))
        return pd.DataFrame({"removed": removed, "kept": kept})

    return cut


def dedup(docs: DataFrame, length: int = LENGTH, text: str = "text", out: str = "repeats") -> DataFrame:
    """``docs`` with the struct column ``out``: removed (byte ranges of the text as UTF-8), kept (the bytes that stay)."""
    bounded_batches(docs.sparkSession)
    as_bytes = F.coalesce(F.col(text), F.lit("")).cast("binary")
    sid = F.substring(F.unhex(F.sha2(as_bytes, 256)), 1, 16)
    texts = docs.select(sid.alias("sid"), as_bytes.alias("text"), F.lit(1).cast("long").alias("copies"))
    spans = _spans(texts.filter(F.length("text") >= length), length, key_bytes(length))
    met = docs.withColumn("__sid", sid).join(spans.select(F.col("sid").alias("__sid"), F.col("spans").alias("__spans")), "__sid", "left")
    return met.withColumn(out, _cut(length)(as_bytes, F.col("__spans"))).drop("__sid", "__spans")


def digest(found: DataFrame, column: str = "repeats") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 from ``dedup``'s column."""
    removed: Column = F.aggregate(f"{column}.removed", F.lit(0).cast("long"), lambda a, r: a + (r["stop"] - r["start"]))
    kept = F.col(f"{column}.kept")
    return found.select(
        "doc_id", (F.length(kept) + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size(f"{column}.removed").cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))
