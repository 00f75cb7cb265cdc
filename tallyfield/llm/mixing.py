"""Mixing sources to target weights, with DataFrame functions only.

Sizes are aggregated per source, targets are shared out by weight under a cap per source (water-filling), a
source's repetition rate is target / size, and each document is emitted floor(rate) times plus one copy with
probability equal to the fraction; the draw is a hash of seed, doc_id and the whole text, so reruns agree.

Defined cases: null texts have size 0; null is a source of its own, last in order; a source without words has
target 0 and rate 0; rows with equal doc_id and text draw alike; an empty table gives no rows. In plan(), columns of docs
that are named size, source_size, target or copies are replaced by the plan's; mix() returns the columns of docs untouched.
The shares are worked out in windows over one row a source, in one task: some millions of sources at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialise

WEIGHTS = (5, 2, 1)
SHARE, CAP, SEED = 1.5, 2.0, 20
#: Shares of a source's rows when its targets are too many to broadcast.
SALTS = 64


def size_of(text: Column) -> Column:
    """Number of words: runs without space, tab, line feed, vertical tab, form feed, carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, target: share of all sizes by weight, no source above cap times its size.

    With sources in order of cap / weight, the capped ones are a prefix; the level (target per weight) after the
    first k are capped is what is left divided by the weights that are left, and the first k whose level does not
    pass the next source's own ratio is right. totals has one row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("cap") / F.col("w"))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share))).withColumn("all_w", F.sum("w").over(every))
    t = t.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    t = t.withColumn("k", F.row_number().over(Window.orderBy("ratio", F.col("source").isNull(), "source")))
    t = t.withColumn("final", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("k", "level"))).over(every)["level"])
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("final") * F.col("w")))
    return t.select("source", "source_size", target.alias("target"))


def draw(seed: int, *by: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and columns."""
    digits = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in by]))
    return F.conv(F.substring(digits, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """docs with size, source_size, target and copies, the number of times that the mix takes the document."""
    planned = _planned(docs, weights, share, cap, seed)
    named = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return planned.select(*named, F.col("__size").alias("size"), F.col("__size_all").alias("source_size"), F.col("__target").alias("target"), F.col("__copies").alias("copies"))


def _planned(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """row (a struct of the columns of docs), __size, __size_all, __target and __copies."""
    sized = docs.select("doc_id", "source", "text").select("source", size_of(F.col("text")).alias("size"))
    goal = materialise(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap))
    goal = goal.select(F.col("source").alias("__source"), F.col("source_size").alias("__size_all"), F.col("target").alias("__target"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text", size_of(F.col("text")).alias("__size"))
    if goal.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(goal), F.col("source").eqNullSafe(F.col("__source")), "left")
    else:  # many sources: a shuffle, in which each source's rows are spread over SALTS keys
        goal = goal.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("__draw_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        joined = rows.join(goal, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__draw_salt") == F.col("__salt")), "left")
    rate = F.when(F.col("__size_all") > 0, F.least(F.col("__target") / F.col("__size_all"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + (draw(seed, F.col("doc_id"), F.md5("text")) < rate - whole).cast("long")
    return joined.select("row", "__size", "__size_all", "__target", copies.alias("__copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document copies times, with the columns of docs."""
    taken = _planned(docs, **how).where("__copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select("row.*")
