"""URL rules judged by Bloom filter cascades.

A rule is a host and a path prefix, written as one text (``example.org/es/``);
it fits its host and all subdomains where the url's path starts with the
rule's path.  Every url has few candidate keys: each of its host's
suffixes joined with the beginnings of its path, at the lengths that rule
paths have.  The longest candidate that is a listed rule wins (of equal
length, the longer host); a url without one is not listed and gets
``default``.

A cascade answers whether a key is listed.  Level 1 is a Bloom filter of
the listed keys; level 2 one of the keys of the corpus that level 1 takes
by mistake; level 3 one of the listed keys that level 2 takes by mistake,
and so on until a level makes no mistake.  The mistakes are searched among
*all* candidate keys of the corpus, so the answer is exact for each of
them and judging a url needs no join.  There is one cascade for blocked and
one for allowed rules.

Spread: candidate keys are made distinct and hashed by Spark; the bits of a
filter are ORed word by word in a grouped aggregation, and the driver
receives the finished words only.  Their number follows the rules, and is
checked against ``max_bytes`` before anything is sent to the tasks; a
longer rule list is judged by an ordinary shuffled join instead
(``judge_by_join``), with the same result.

Edge cases: a null url, or one without ``://``, has an empty host and path
and fits no rule; an empty table or rule list gives defaults only; a rule
listed both ways blocks; repeated urls and rules do no harm.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, store

# The contract's rules.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
DEFAULT = "allow"
MAX_BYTES = 64 << 20
MAX_LEVELS = 100

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def split_rule(rule: Column) -> tuple[Column, Column]:
    """Host and path of a rule's text."""
    at = F.instr(rule, "/")
    host = F.when(at > 0, F.substring(rule, F.lit(1), at - 1)).otherwise(rule)
    return host, F.when(at > 0, F.substring(rule, at, F.length(rule))).otherwise(F.lit(""))


# ---- Bloom filters ---------------------------------------------------------------------------------------------------


def hashed(keys: list[str]) -> np.ndarray:
    """128 bits of each key, as two unsigned numbers."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(k.encode()) for k in keys), dtype=">u8").astype(np.uint64).reshape(-1, 2)


def _positions(h: np.ndarray, level: int, k: int, bits: int) -> np.ndarray:
    """k bit positions of each key; every level hashes differently."""
    step = h[:, 1] * np.uint64(2 * level + 0x9E3779B97F4A7C15) | np.uint64(1)
    first = (h[:, 0] ^ (h[:, 1] >> np.uint64(level % 31 + 1))) * np.uint64(2 * level + 0xBF58476D1CE4E5B9)
    first ^= first >> np.uint64(31)
    with np.errstate(over="ignore"):
        spots = first[:, None] + step[:, None] * np.arange(k, dtype=np.uint64)[None, :]
    spots ^= spots >> np.uint64(29)
    return spots % np.uint64(bits)


class Bloom:
    def __init__(self, level: int, k: int, bits: int, words: np.ndarray | None = None):
        self.level, self.k, self.bits = level, k, bits
        self.words = np.zeros(bits // 64, dtype=np.uint64) if words is None else words

    def add(self, h: np.ndarray) -> None:
        at = _positions(h, self.level, self.k, self.bits).ravel()
        np.bitwise_or.at(self.words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))

    def test(self, h: np.ndarray) -> np.ndarray:
        at = _positions(h, self.level, self.k, self.bits)
        return ((self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


class Cascade:
    """The levels' filters; ``holds`` is exact for listed keys and for all keys of the universe it was built over."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def holds(self, h: np.ndarray) -> np.ndarray:
        listed = np.zeros(len(h), dtype=bool)
        left = np.arange(len(h))
        for n, bloom in enumerate(self.levels):
            took = bloom.test(h[left])
            listed[left[~took]] = n % 2 == 1  # refused by an even level: not one of the mistakes
            left = left[took]
        listed[left] = len(self.levels) % 2 == 1
        return listed


def _plan(n: int, rate: float) -> tuple[int, int]:
    """(hash functions, bits) of a filter of n keys."""
    bits = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2 / 64) * 64)
    return max(1, round(math.log2(1 / rate))), bits


def _first_rate(n_listed: int, n_others: int) -> float:
    return min(0.5, n_listed * math.sqrt(0.5) / max(1, n_others))


def filter_bytes(n_listed: int, n_others: int) -> float:
    """Bytes of the first two levels; the rest together are smaller."""
    first = _plan(n_listed, _first_rate(n_listed, n_others))[1]
    return (first + 2 * _plan(n_listed, 0.5)[1]) / 8


def _hash_rows(keys: DataFrame) -> DataFrame:
    def rows(batches):
        for b in batches:
            h = hashed(list(b["key"])).view(np.int64)
            yield pd.DataFrame({"a": h[:, 0], "b": h[:, 1]})

    return keys.mapInPandas(rows, "a long, b long")


def _numbers(batch: pd.DataFrame) -> np.ndarray:
    return np.stack([batch["a"].to_numpy().view(np.uint64), batch["b"].to_numpy().view(np.uint64)], axis=1)


def _filled(keys: DataFrame, n: int, rate: float, level: int) -> Bloom:
    k, bits = _plan(n, rate)

    def partial(batches):
        bloom = Bloom(level, k, bits)
        for b in batches:
            bloom.add(_numbers(b))
        at = np.flatnonzero(bloom.words)
        yield pd.DataFrame({"word": at, "mask": bloom.words[at].view(np.int64)})

    found = keys.mapInPandas(partial, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).collect()
    words = np.zeros(bits // 64, dtype=np.uint64)
    for r in found:
        words[r["word"]] = r["mask"] & 0xFFFFFFFFFFFFFFFF
    return Bloom(level, k, bits, words)


def _taken(keys: DataFrame, bloom: Bloom) -> DataFrame:
    def rows(batches):
        for b in batches:
            yield b[bloom.test(_numbers(b))]

    return keys.mapInPandas(rows, "a long, b long")


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of the ``listed`` keys, exact over the ``universe`` (both: distinct, column ``key``)."""
    bounded_batches(listed.sparkSession)
    inside = store(_hash_rows(listed), "cascade")
    outside = store(_hash_rows(universe.join(listed, "key", "left_anti")), "cascade")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Bloom] = []
    rate = _first_rate(n_in, n_out) if n_in else 0.5
    while n_in or not levels:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: two keys have the same 128 hash bits")
        levels.append(_filled(inside, n_in, rate, len(levels)))
        mistaken = store(_taken(outside, levels[-1]), "cascade")
        inside, outside, n_in, n_out, rate = mistaken, inside, mistaken.count(), n_in, 0.5
    return Cascade(levels)


# ---- judging ---------------------------------------------------------------------------------------------------------


def rule_table(spark, rules) -> DataFrame:
    return spark.createDataFrame([(r, v) for v, r in rules], "key string, verdict string")


def _candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """All candidate keys of a url as structs (host part's length, key)."""
    labels = F.split(host, r"\.", -1)
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))

    def joined(head: Column) -> Column:
        return F.transform(suffix, lambda s: F.when(head.isNotNull(), F.struct(F.length(s).alias("n"), F.concat(s, head).alias("key"))))

    pairs = [joined(F.when(F.length(path) >= n, F.substring(path, 1, n))) for n in lengths]
    every = F.concat(*pairs) if pairs else F.array().cast("array<struct<n:int,key:string>>")
    return F.when(host != "", F.filter(every, lambda x: x.isNotNull()))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``rules``: key (host and path as one text), verdict (allow or block)."""
    rules = store(rules.select("key", "verdict").distinct(), "rules")
    _, rule_path = split_rule(F.col("key"))
    lengths = sorted(r[0] for r in rules.select(F.length(rule_path)).distinct().collect())
    parts = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    keys = parts.select(F.explode(_candidates(F.col("host"), F.col("path"), lengths)).alias("c")).select("c.key").distinct()
    universe = store(keys, "url-keys")
    n_rules, n_keys = rules.count(), universe.count()
    if not n_rules:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    if filter_bytes(n_rules, n_keys) > max_bytes:
        return judge_by_join(parts, rules, lengths, default)
    block = cascade(rules.filter("verdict = 'block'").select("key").distinct(), universe)
    allow = cascade(rules.filter("verdict <> 'block'").select("key").distinct(), universe)
    held = pages.sparkSession.sparkContext.broadcast((block, allow))

    @F.pandas_udf("rule string, verdict string")
    def decide(found: pd.Series) -> pd.DataFrame:
        block, allow = held.value
        row, size, head, key = [], [], [], []
        for r, cs in enumerate(found):
            for c in cs if cs is not None else ():
                row.append(r)
                head.append(c["n"])
                key.append(c["key"])
                size.append(len(c["key"]))
        rule, verdict = np.full(len(found), None, dtype=object), np.full(len(found), default, dtype=object)
        if key:
            h = hashed(key)
            blocked, allowed = block.holds(h), allow.holds(h)
            order = np.lexsort((head, size))  # the longest comes last and stays
            for i in order[(blocked | allowed)[order]]:
                rule[row[i]], verdict[row[i]] = key[i], "block" if blocked[i] else "allow"
        return pd.DataFrame({"rule": rule, "verdict": verdict})

    out = parts.withColumn("__j", decide(_candidates(F.col("host"), F.col("path"), lengths)))
    return out.withColumns({"rule": F.col("__j.rule"), "verdict": F.col("__j.verdict")}).drop("__j")


def judge_by_join(parts: DataFrame, rules: DataFrame, lengths: list[int], default: str = DEFAULT) -> DataFrame:
    """The same by a shuffled join of the distinct candidate keys, for rule lists too long to send to every task."""
    distinct = parts.select("host", "path").distinct()
    listed = rules.groupBy("key").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    found = distinct.select("host", "path", F.explode(_candidates(F.col("host"), F.col("path"), lengths)).alias("c"))
    found = found.select("host", "path", "c.n", "c.key").join(listed, "key")
    best = found.groupBy("host", "path").agg(F.max(F.struct(F.length("key"), "n", "key", "verdict")).alias("b"))
    out = parts.join(best, ["host", "path"], "left")
    out = out.withColumns({"rule": F.col("b.key"), "verdict": F.coalesce("b.verdict", F.lit(default))})
    return out.select(*dict.fromkeys([*parts.columns, "rule", "verdict"]))


def _rule_sql() -> str:
    fits = []
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        host, path = rule.split("/", 1)
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", rule, verdict))
    rules = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)
    verdicts = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    return f"CASE {rules} END AS rule, CASE {verdicts} ELSE '{DEFAULT}' END AS verdict"


ORACLE = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path FROM pages)
SELECT page_id, host, path, {_rule_sql()} FROM parts
"""
