"""Mixing sources to target weights by weighted fair queueing.

Every document has a place in its source's shuffled order (an MD5 key of a
seed, its id and its text, so reruns agree).  A source's documents may be
passed up to ``max_epochs`` times.  A document's virtual finish time in
pass ``e`` is the source's words served up to and with it, divided by the
source's target; all documents are sorted by that time over the whole
corpus and taken until the total budget is spent.

How it is spread: words are summed by (source, key prefix); prefix sums
run over these short tables in two levels, so a source with a third of
all documents is cut into ``16**PREFIX`` even pieces and no window holds
more than one piece.  Because every source is served at the rate of its
target, the virtual times are evenly filled; the cut is searched by two
rounds of a fixed grid over them, and only the documents of one grid cell
are put in order.  The driver reads single numbers only.

Edge cases: a null text has 0 words; a null source is a source of its
own, ordered last; documents without words are taken 0 words; equal rows
share one place and are taken alike; an empty table gives an empty mix;
with no words at all every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, store

WEIGHTS = (1, 2, 3)  # repeating, over the sources by code point
MAX_EPOCHS = 3
PREFIX = 3  # hexadecimal digits of the shuffle key that name a piece of a source
GRID = 1024
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    blank = F.lit("")
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), blank), F.lit("|"), F.coalesce(text, blank)).cast("binary"))


def _source_key(source: Column) -> Column:
    """A key without nulls that sorts like the source, null last."""
    return F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(skey, source_size, target) from (skey, source_size): shares by weight, capped, the excess shared again.

    One row per source.  Sorted by cap over weight, a source is capped just
    if its share of what the sources before it leave reaches its cap; the
    comparison is exact (decimal integers).
    """
    dec = "decimal(38,0)"
    by_name, everything = W.orderBy("skey"), W.partitionBy()
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", weight.cast("long"))
    t = t.withColumn("cap", F.col("source_size") * max_epochs).withColumn("total", F.sum("source_size").over(everything))
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("skey").asc())
    before, onward = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    t = t.withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("left_w", F.sum("weight").over(onward))
    capped = F.col("cap").cast(dec) * F.col("left_w").cast(dec) <= F.col("weight").cast(dec) * (F.col("total") - F.col("spent")).cast(dec)
    t = t.withColumn("capped", capped)
    t = t.withColumn("spent_all", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
    t = t.withColumn("w_all", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything))
    free = (F.col("total") - F.col("spent_all")).cast("double") * F.col("weight").cast("double") / F.col("w_all").cast("double")
    return t.select("skey", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(free).alias("target"))


def _finish(epoch: int) -> Column:
    """Virtual finish time in pass ``epoch``; null without a target."""
    served = (F.col("cum") + F.lit(epoch) * F.col("source_size")).cast("double")
    return F.when((F.col("target") > 0) & (F.col("size") > 0), served / F.col("target"))


def _place(epoch: int) -> Column:
    return F.struct(_finish(epoch).alias("finish"), F.col("skey"), F.col("key"), F.lit(epoch).alias("epoch"), F.col("size"))


def _cut(queued: DataFrame, budget: int, epochs: int, grid: int):
    """The last place that the budget reaches, as (finish, skey, key, epoch, size); None if it reaches none."""
    passes = queued.select(F.explode(F.array(*[_place(e) for e in range(epochs)])).alias("p")).select("p.*").filter("finish is not null")
    lo, hi, spent = 0.0, None, 0
    for _ in range(2):
        width = (hi - lo) / grid if hi is not None else 2.0 / grid
        cells = (2 if hi is None else 1) * grid  # of the first round, the last cell is open
        cell = F.least(F.floor((F.col("finish") - lo) / width), F.lit(cells)).cast("long")
        inside = passes.filter(F.col("finish") >= lo) if hi is None else passes.filter((F.col("finish") >= lo) & (F.col("finish") < hi))
        sums = inside.groupBy(cell.alias("cell")).agg(F.sum("size").alias("n"), F.min("finish").alias("first"), F.max("finish").alias("last"))
        run = sums.withColumn("run", F.sum("n").over(W.orderBy("cell")))
        at = run.filter(F.col("run") > budget - spent).orderBy("cell").select("run", "n", "first", "last").first()
        if at is None:  # the budget reaches everything inside
            break
        spent += at["run"] - at["n"]
        lo, last = at["first"], at["last"]
        if last <= lo:
            hi = None
            passes = passes.filter(F.col("finish") <= last)
            break
        hi = last * (1 + 1e-15) + 5e-324
    inside = passes.filter(F.col("finish") >= lo) if hi is None else passes.filter((F.col("finish") >= lo) & (F.col("finish") < hi))
    order = W.orderBy("finish", "skey", "key", "epoch", "size").rangeBetween(W.unboundedPreceding, W.currentRow)
    place = F.struct("finish", "skey", "key", "epoch", "size")
    reached = inside.withColumn("run", F.sum("size").over(order)).filter(F.col("run") <= budget - spent).agg(F.max(place).alias("p")).first()["p"]
    if reached is None:
        reached = passes.filter(F.col("finish") < lo).agg(F.max(place).alias("p")).first()["p"]
    return reached


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, prefix: int = PREFIX, grid: int = GRID, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, key, size, source_size, target, first_finish, copies (0 to ``max_epochs``), taken."""
    base = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), _source_key(F.col("source")).alias("skey"),
        shuffle_key(F.col("doc_id"), F.col("text"), seed).alias("key"), word_count(F.col("text")).alias("size"),
    )
    base = store(base, "mix-base").withColumn("piece", F.substring("key", 1, prefix))
    pieces = base.groupBy("skey", "piece").agg(F.sum("size").alias("n")).withColumn("head", F.substring("piece", 1, (prefix + 1) // 2))
    by_source = targets(pieces.groupBy("skey").agg(F.sum("n").alias("source_size")), weights, max_epochs)
    heads = pieces.groupBy("skey", "head").agg(F.sum("n").alias("h"))
    heads = heads.withColumn("before_head", F.sum("h").over(W.partitionBy("skey").orderBy("head")) - F.col("h"))
    heads = heads.join(by_source, "skey").drop("h")
    pieces = pieces.withColumn("before", F.sum("n").over(W.partitionBy("skey", "head").orderBy("piece")) - F.col("n"))
    offsets = pieces.join(heads, ["skey", "head"]).select(
        "skey", "piece", (F.col("before") + F.col("before_head")).alias("offset"), "source_size", "target"
    )
    # Peers (equal key and size) share one place: the running sum is over a range, not over rows.
    inner = W.partitionBy("skey", "piece").orderBy("key", "size").rangeBetween(W.unboundedPreceding, W.currentRow)
    queued = base.withColumn("inner", F.sum("size").over(inner)).join(offsets, ["skey", "piece"])
    queued = store(queued.select("doc_id", "source", "skey", "key", "size", (F.col("offset") + F.col("inner")).alias("cum"), "source_size", "target"), "mix-queue")
    budget = queued.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    p = _cut(queued, budget, max_epochs, grid) if budget else None
    if p is None:
        copies = F.lit(0)
    else:
        last = F.struct(F.lit(p["finish"]).alias("finish"), F.lit(p["skey"]).alias("skey"), F.lit(p["key"]).alias("key"),
                        F.lit(p["epoch"]).alias("epoch"), F.lit(p["size"]).cast("long").alias("size"))
        copies = sum((F.when(_finish(e).isNotNull() & (_place(e) <= last), 1).otherwise(0) for e in range(max_epochs)), F.lit(0))
    queued = queued.withColumn("copies", copies.cast("int"))
    return queued.select("doc_id", "source", "skey", "key", "size", "source_size", "target", _finish(0).alias("first_finish"), "copies",
                         (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, with ``mix_size``, ``mix_target``, ``mix_finish`` and ``mix_copies`` added.

    Repeats are a count, not rows.  The decision is joined back on the
    shuffle key and the source; equal rows share it.
    """
    plan = mix(docs, **options).filter("copies > 0").select(
        F.col("skey").alias("__skey"), F.col("key").alias("__key"), F.col("size").alias("mix_size"),
        F.col("target").alias("mix_target"), F.col("first_finish").alias("mix_finish"), F.col("copies").alias("mix_copies"),
    ).dropDuplicates(["__skey", "__key"])
    keyed = docs.withColumns({"__skey": _source_key(F.col("source")), "__key": shuffle_key(F.col("doc_id"), F.col("text"), options.get("seed", SEED))})
    return keyed.join(plan, ["__key", "__skey"]).drop("__key", "__skey")


ORACLE = f"""
WITH base AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS skey,
         md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT skey, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS weight
  FROM base GROUP BY skey),
filled AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
  FROM sources WINDOW o AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), skey)),
flagged AS (SELECT *, cap * left_w <= weight * (total - spent) AS capped FROM filled),
targets AS (
  SELECT skey, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS DOUBLE) * CAST(weight AS DOUBLE)
                   / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target
  FROM flagged),
queued AS (
  SELECT b.*, t.source_size, t.target, sum(size) OVER (PARTITION BY b.skey ORDER BY key, size) AS cum
  FROM base b JOIN targets t USING (skey)),
places AS (
  SELECT skey, key, size, epoch, CAST(cum + epoch * source_size AS DOUBLE) / target AS finish
  FROM queued CROSS JOIN (SELECT unnest([0, 1, 2]) AS epoch) WHERE target > 0 AND size > 0),
ran AS (
  SELECT skey, key, size, epoch, sum(size) OVER (ORDER BY finish, skey, key, epoch, size) AS run FROM places),
taken AS (
  SELECT skey, key, size, count(DISTINCT epoch) AS copies FROM ran
  WHERE run <= (SELECT sum(size) FROM base) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(t.copies, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t ON q.skey = t.skey AND q.key = t.key AND q.size = t.size
"""
