"""Campaign events folded to one state per key, in batch and as streams.

The fold is monotone (the highest rank wins, first dates stay), so events may come late, twice or in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ("draft_ready", "sent", "responded", "bounced")


def fold(events: DataFrame, key: str, kind: str = "kind", at: str = "ts") -> DataFrame:
    """key, status (the highest of STATES seen), date_<state> (first time of each) and n_events."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col(kind))
    known = events.where(F.col(kind).isin(*STATES))
    out = known.groupBy(key).agg(F.max(rank).alias("__r"), F.count("*").alias("n_events"), *[F.min(F.when(F.col(kind) == s, F.col(at))).alias(f"date_{s}") for s in STATES])
    return out.withColumn("status", F.element_at(F.array(*[F.lit(s) for s in STATES]), F.col("__r").cast("int"))).drop("__r")


def merge(state: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Two folds as one; n_events adds up, so `more` must hold new events only."""
    both = state.unionByName(more)
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("status"))
    out = both.groupBy(key).agg(F.max(rank).alias("__r"), F.sum("n_events").alias("n_events"), *[F.min(f"date_{s}").alias(f"date_{s}") for s in STATES])
    return out.withColumn("status", F.element_at(F.array(*[F.lit(s) for s in STATES]), F.col("__r").cast("int"))).drop("__r")


def deduplicated(events: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """A stream without repeats that come within the delay."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def funnel_by_window(events: DataFrame, kind: str, at: str, width: str, slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Counts of each kind per tumbling or sliding window; delay bounds the state of a stream."""
    df = events.withWatermark(at, delay) if delay else events
    w = F.window(at, width, slide) if slide else F.window(at, width)
    return df.groupBy(w.alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), kind, "n")


def sessions(events: DataFrame, key: str, at: str, gap: str, delay: str | None = None) -> DataFrame:
    """Sessions per key: begin, end and number of events; a session ends `gap` after its last event."""
    df = events.withWatermark(at, delay) if delay else events
    return df.groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
