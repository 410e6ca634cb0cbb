"""Benchmark decontamination: one Aho-Corasick automaton over the items' windows.

Items and documents are normalised alike (A-Z lower-cased; words are runs
of characters other than ASCII control, blank and punctuation).  Every
window of ``window`` consecutive item words (an item of fewer words, but
not none, is one window) becomes a pattern ``" w1 w2 ... "``.  A document
is scanned once; a match is turned into word numbers and, through the
words' offsets, into spans of the original text.

The automaton is the only thing sent to every task.  It grows with the
benchmark, not with the corpus.  Long items are cut into pieces that
overlap by a window less one word, and the pieces are dealt into parts whose
windows have at most about ``part_chars`` characters, which bounds the nodes
of an automaton.  A benchmark of one part, the usual case, is one scan.  With
several parts the documents are stored, every part is a scan of its own
that keeps only the documents it hits, its items leave the driver and the
executors before the next part is read, and the hits are merged by document.
So a large benchmark costs more scans, not more memory.

Edge cases: a null or empty text has no words and no hits; a null or empty
item has no windows; an item with a null id marks words as hit but cannot
be listed; repeated items and ids count once; an empty benchmark hits
nothing.  Other columns of either table are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, evaluated_once, store

WINDOW = 10
PART_CHARS = 6 << 20  # characters of all windows behind one automaton: at most as many nodes, of some 80 bytes
PIECE_WORDS = 1000  # windows that start in one piece of an item

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)
_RUN = re.compile(rb"[^ ]+")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HITS = "runs array<struct<a:int,b:int>>, items array<string>"
FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,stop:int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def patterns(pieces: list[tuple[str | None, int, bytes]]) -> dict[str, tuple[int, set]]:
    """Pattern text -> (its length in words, the ids of the items that hold it), of (item id, window size, text) pieces."""
    found: dict[str, tuple[int, set]] = {}
    for item_id, size, text in pieces:
        words = words_of(text)
        for i in range(len(words) - size + 1):
            key = (b" " + b" ".join(words[i : i + size]) + b" ").decode()
            found.setdefault(key, (size, set()))[1].add(item_id)
    return found


_HELD: dict = {}  # in a Python worker: the automaton it used last, by its scanner's name


class Scanner:
    """The automaton of one part; a worker builds it once and holds no other beside it."""

    def __init__(self, pieces):
        self.pieces, self.name = pieces, uuid.uuid4().hex

    def automaton(self):
        import ahocorasick

        if self.name not in _HELD:
            _HELD.clear()
            machine = ahocorasick.Automaton()
            for key, value in patterns(self.pieces.value).items():
                machine.add_word(key, value)
            if len(machine):
                machine.make_automaton()
            _HELD[self.name] = machine
        return _HELD[self.name]

    def scan(self, texts: list[bytes | None]) -> list[tuple]:
        """(words, per-word hit flags or None, item ids) of each text."""
        machine = self.automaton()
        out = []
        for words in map(words_of, texts):
            hit, ids = None, set()
            if words and len(machine):
                norm = (b" " + b" ".join(words) + b" ").decode()
                for end, (size, items) in machine.iter(norm):
                    if hit is None:
                        ends = np.cumsum([len(w.decode()) + 1 for w in words])
                        hit = np.zeros(len(words), dtype=bool)
                    last = int(np.searchsorted(ends, end))
                    hit[last - size + 1 : last + 1] = True
                    ids |= items
            out.append((words, hit, ids))
        return out


def runs_of(hit: np.ndarray | None) -> list[tuple[int, int]]:
    """The runs of hit words, as word numbers."""
    if hit is None:
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]


def spans_of(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of the runs of hit words in the original text."""
    at = np.array([m.span() for m in _RUN.finditer(text.translate(_TABLE))])
    return [(int(at[a, 0]), int(at[b - 1, 1])) for a, b in runs_of(hit)]


def _found(text: bytes | None, n_words: int, hit: np.ndarray | None, ids) -> tuple:
    """A document's row of ``FOUND``."""
    spans = [] if hit is None else [{"start": len(text[:a].decode()), "stop": len(text[:b].decode())} for a, b in spans_of(text, hit)]
    return n_words, 0 if hit is None else int(hit.sum()), sorted(i for i in ids if i is not None), spans


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])


def _pieces(benchmark: DataFrame, window: int, part_chars: int) -> tuple[DataFrame, int]:
    """item_id, size (words of its windows), text, part of the items' pieces, and the number of parts."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.translate("text", _UPPER, _UPPER.lower()).alias("text"))
    words = F.filter(F.split("text", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    items = items.where(F.length("text") > 0).distinct().select("item_id", words.alias("words")).where(F.size("words") > 0)
    items = items.withColumn("size", F.least(F.lit(window), F.size("words")))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1, F.lit(PIECE_WORDS))
    pieces = items.withColumn("start", F.explode(starts)).select(
        "item_id", "size", F.array_join(F.slice("words", F.col("start"), F.lit(PIECE_WORDS - 1) + F.col("size")), " ").alias("text"))
    pieces = pieces.distinct()
    # All windows of a piece have at most this many characters, blanks included.
    chars = (F.col("size") + 1).cast("long") * (F.length("text") + 1)
    total = pieces.agg(F.coalesce(F.sum(chars), F.lit(0))).first()[0]
    n_parts = max(1, -(-total // part_chars))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)))
    if n_parts > 1:
        pieces = store(pieces.repartition("part").sortWithinPartitions("part"), "decontam-pieces")
    return pieces, n_parts


def _scanner(pieces: DataFrame, part: int) -> Scanner:
    """The pieces of one part, which ``part_chars`` bounds, sent to the workers."""
    rows = pieces.where(F.col("part") == part).select("item_id", "size", F.col("text").cast("binary")).collect()
    return Scanner(pieces.sparkSession.sparkContext.broadcast([(i, n, bytes(t)) for i, n, t in rows]))


def scan(docs: DataFrame, benchmark: DataFrame, found: str = "found", text: str = "text",
         window: int = WINDOW, part_chars: int = PART_CHARS) -> DataFrame:
    """``docs`` with the struct column ``found``: n_words, n_hit, items (sorted ids), spans (character offsets of hit runs)."""
    bounded_batches(docs.sparkSession)
    pieces, n_parts = _pieces(benchmark, window, part_chars)
    return _scan_parts(docs, pieces, n_parts, found, text) if n_parts > 1 else _scan_once(docs, _scanner(pieces, 0), found, text)


def _scan_once(docs: DataFrame, scanner: Scanner, found: str, text: str) -> DataFrame:
    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        raw = [None if t is None else bytes(t) for t in texts]
        return _frame([_found(t, len(words), hit, ids) for t, (words, hit, ids) in zip(raw, scanner.scan(raw))])

    return docs.withColumn(found, find(F.col(text).cast("binary")))


def _hits_of(scanner: Scanner):
    @F.pandas_udf(HITS)
    def hits(texts: pd.Series) -> pd.DataFrame:
        rows = scanner.scan([None if t is None else bytes(t) for t in texts])
        return pd.DataFrame([([{"a": a, "b": b} for a, b in runs_of(hit)], sorted(ids, key=str)) for _, hit, ids in rows], columns=["runs", "items"])

    return evaluated_once(hits)


def _scan_parts(docs: DataFrame, pieces: DataFrame, n_parts: int, found: str, text: str) -> DataFrame:
    """One pass over the stored documents for each part, then the hits of a document together."""
    key = "__document"
    while key in docs.columns:
        key += "_"
    keyed = store(docs.withColumn(key, F.monotonically_increasing_id()), "decontam-docs")  # stored: the numbers stay
    hits = []
    for part in range(n_parts):
        scanner = _scanner(pieces, part)
        some = keyed.select(key, _hits_of(scanner)(F.col(text).cast("binary")).alias("h")).where(F.size("h.runs") > 0)
        hits.append(store(some.select(key, "h.*"), "decontam-hits"))
        scanner.pieces.destroy()
    every = reduce(DataFrame.unionByName, hits).groupBy(key).agg(
        F.flatten(F.collect_list("runs")).alias("__runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("__items"))

    @F.pandas_udf(FOUND)
    def merge(texts: pd.Series, runs: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for t, some, ids in zip(texts, runs, items):
            t = None if t is None else bytes(t)
            n, hit = len(words_of(t)), None
            if some is not None:
                hit = np.zeros(n, dtype=bool)
                for r in some:
                    hit[r["a"] : r["b"]] = True
            rows.append(_found(t, n, hit, () if ids is None else ids))
        return _frame(rows)

    joined = keyed.withColumnRenamed(key, key + "k").join(every, F.col(key + "k") == F.col(key), "left")
    out = joined.withColumn(found, merge(F.col(text).cast("binary"), F.col("__runs"), F.col("__items")))
    return out.select(*[c for c in docs.columns if c != found], found)


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans; a line break stands for each."""
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a].rstrip(b" \t"))
        at = b
    return b"\n".join(kept + [text[at:].lstrip(b" \t")])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, part_chars: int = PART_CHARS) -> DataFrame:
    """``docs`` with the hit runs cut out of the text (a line break stands in their place); other texts stay as they are.

    A cut text is scanned again until nothing is hit, so no window is left
    in the result, not even one that a cut has made.
    """
    bounded_batches(docs.sparkSession)
    pieces, n_parts = _pieces(benchmark, window, part_chars)
    if n_parts > 1:
        return _clean_parts(docs, pieces, n_parts, text)
    scanner = _scanner(pieces, 0)

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        raw = [None if t is None else bytes(t) for t in texts]
        todo = list(range(len(raw)))
        while todo:
            found = [(k, hit) for k, (_, hit, _) in zip(todo, scanner.scan([raw[k] for k in todo])) if hit is not None]
            for k, hit in found:
                raw[k] = _without(raw[k], spans_of(raw[k], hit))
            todo = [k for k, _ in found]
        return pd.Series([None if t is None else t.decode() for t in raw], dtype=object)

    return docs.withColumn(text, evaluated_once(cut)(F.col(text).cast("binary")))


def _clean_parts(docs: DataFrame, pieces: DataFrame, n_parts: int, text: str) -> DataFrame:
    """Rounds of scans over the documents that the round before has cut, until none is hit."""
    mark = "__found"
    while mark in docs.columns:
        mark += "_"

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, some in zip(texts, spans):
            at = [(len(t[: s["start"]].encode()), len(t[: s["stop"]].encode())) for s in some]
            out.append(_without(t.encode(), at).decode())
        return pd.Series(out, dtype=object)

    done, left = [], docs
    while True:
        seen = store(_scan_parts(left, pieces, n_parts, mark, text), "decontam-round")
        done.append(seen.where(F.col(mark)["n_hit"] == 0).drop(mark))
        hit = seen.where(F.col(mark)["n_hit"] > 0)
        if hit.isEmpty():
            return reduce(DataFrame.unionByName, done).select(*docs.columns)
        left = hit.withColumn(text, cut(F.col(text), F.col(mark)["spans"])).drop(mark)


def digest(scanned: DataFrame, found: str = "found") -> DataFrame:
    """The contract's columns of a scanned table."""
    f = F.col(found)
    return scanned.select(
        "doc_id",
        f["n_words"].alias("n_words"),
        f["n_hit"].alias("n_hit"),
        F.size(f["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", f["items"]), 256).alias("items_sha256"),
        (f["n_hit"] > 0).alias("contaminated"),
    )


def brute_force(texts: list, items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """Plain reference for tests: (n_words, n_hit, n_items, sha256 of the ids) by comparing word lists."""
    def plain(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    out = []
    for t in texts:
        words = plain(t)
        hit, ids = set(), set()
        for item_id, item in items:
            iw = plain(item)
            size = min(window, len(iw))
            for i in range(len(iw) - size + 1 if size else 0):
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == iw[i : i + size]:
                        hit |= set(range(j, j + size))
                        ids.add(item_id)
        listed = sorted(str(i) for i in ids if i is not None)
        out.append((len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest()))
    return out


_WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH items AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), {WINDOW}) AS size, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i, w
  FROM items WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS gram FROM windows),
sizes AS (SELECT DISTINCT size FROM grams),
docs AS (SELECT row_number() OVER () AS uid, doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
places AS (
  SELECT uid, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM docs JOIN sizes ON len(w) >= size),
found AS (
  SELECT uid, p.i, p.size, g.item_id FROM places p
  JOIN grams g ON g.size = p.size AND g.gram = array_to_string(p.w[p.i : p.i + p.size - 1], ' ')),
hits AS (
  SELECT uid, count(DISTINCT j) AS n_hit
  FROM (SELECT uid, unnest(range(i, i + size)) AS j FROM (SELECT DISTINCT uid, i, size FROM found)) GROUP BY uid),
ids AS (
  SELECT uid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT uid, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (uid) LEFT JOIN ids USING (uid)
"""
