"""Streams with state by key: the lifecycle fold with idempotent writes, and arriving records that were not seen before.

Each micro-batch writes a folder of its own, named by the batch's number and overwritten if the batch runs again, so that a run that dies
between two steps leaves nothing twice. What a batch reads does not grow with what was written: state is in the state store, or in keys that are
kept by bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..sources.store import commit, current_version, read_current
from .lifecycle import STATES

DATES = [f"date_{s}" for s in STATES]
#: What the session needs for lifecycle_stream(): a state store that keeps several states a key; and no batches without data, as with
#: timers by the clock a query over what is available would never end. Timers go off in the next batch that has data.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


class Lifecycle(StatefulProcessor):
    """The fold of one key: its highest state and the first time of each, over events that may come late, twice or in any order.

    Ids of events are remembered for `remember` milliseconds after they came, so that an event that comes again counts once; a key's fold is forgotten
    when no new event came for `idle` milliseconds (a timer). Each batch in which a key has new events gives one row: the fold so far and the number of new events.
    """

    def __init__(self, remember: int, idle: int):
        self.remember, self.idle = remember, idle

    def init(self, handle) -> None:
        self.handle = handle
        self.fold = handle.getValueState("fold", "rank int, " + ", ".join(f"{d} long" for d in DATES))
        self.seen = handle.getMapState("seen", "event_id string", "rank int", self.remember)

    def handleInputRows(self, key, rows, timerValues):
        rank, *dates = tuple(self.fold.get()) if self.fold.exists() else (0, *[None] * len(STATES))
        new = 0
        for row in rows:
            if row.kind not in STATES or row.event_id is None or self.seen.containsKey((row.event_id,)):
                continue
            k = STATES.index(row.kind)
            self.seen.updateValue((row.event_id,), (k + 1,))
            new, rank = new + 1, max(rank, k + 1)
            if row.at is not None and (dates[k] is None or row.at < dates[k]):
                dates[k] = row.at
        if new:
            self.fold.update((rank, *dates))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
            yield Row(key=key[0], status=STATES[rank - 1], n_new=new, **dict(zip(DATES, dates)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.fold.clear()
        self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def lifecycle_changes(events: DataFrame, key: str, event_id: str, kind: str = "kind", at: str = "ts", remember: int = 7 * 86_400_000, idle: int = 365 * 86_400_000) -> DataFrame:
    """key, status, n_new, date_<state>: a row a key and batch that brings new events (a stream, update mode)."""
    rows = events.select(F.col(key).cast("string").alias("key"), F.col(event_id).cast("string").alias("event_id"), F.col(kind).alias("kind"), F.unix_micros(F.col(at).cast("timestamp")).alias("at")).where("key is not null")
    schema = "key string, status string, n_new int, " + ", ".join(f"{d} long" for d in DATES)  # times as microseconds, free of time zones
    out = rows.groupBy("key").transformWithState(Lifecycle(remember, idle), schema, "Update", "ProcessingTime")
    return out.select("key", "status", "n_new", *[F.timestamp_micros(d).alias(d) for d in DATES])


def lifecycle_stream(events: DataFrame, path: str, checkpoint: str, key: str, event_id: str, **how):
    """Starts a query that keeps the table at path up to date; lifecycle_table() reads it. The session needs STATE_STORE."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={number}")

    changes = lifecycle_changes(events, key, event_id, **how)
    return changes.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _folded(changes: DataFrame) -> DataFrame:
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("status"))
    out = changes.groupBy("key").agg(F.max(rank).alias("__r"), F.sum("n_new").alias("n_new"), *[F.min(d).alias(d) for d in DATES])
    return out.select("key", F.element_at(F.array(*[F.lit(s) for s in STATES]), F.col("__r").cast("int")).alias("status"), "n_new", *DATES)


def _changes(spark: SparkSession, path: str) -> DataFrame:
    schema = "key string, status string, n_new int, " + ", ".join(f"{d} timestamp" for d in DATES) + ", batch int"
    return spark.read.schema(schema).option("basePath", f"{path}/changes").parquet(f"{path}/changes").withColumn("n_new", F.col("n_new").cast("long"))


def lifecycle_table(spark: SparkSession, path: str) -> DataFrame:
    """key, status, n_events, date_<state>: one row a key. The fold of a key is monotone, so changes of before and after a key was forgotten agree."""
    base = current_version(spark, f"{path}/base")
    rows = _changes(spark, path).where(F.col("batch") >= base).drop("batch")
    folded = read_current(spark, f"{path}/base", base)
    return _folded(rows if folded is None else rows.unionByName(folded)).select("key", "status", F.col("n_new").alias("n_events"), *DATES)


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """Folds the changes of batches below upto into one table, which readers take from then on; their folders may then be deleted."""
    base = current_version(spark, f"{path}/base")
    if upto <= base:
        return
    changes = _changes(spark, path).where((F.col("batch") >= base) & (F.col("batch") < upto)).drop("batch")
    before = read_current(spark, f"{path}/base", base)
    _folded(changes if before is None else changes.unionByName(before)).write.mode("overwrite").parquet(f"{path}/base/data/version={upto}")
    commit(spark, f"{path}/base", upto)


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def new_records(stream: DataFrame, key: str, path: str, checkpoint: str, seen: DataFrame | None = None, buckets: int = 1024):
    """Starts a query that appends the records of keys not seen before to path/records, one a key; seen: keys that count as seen from the start.

    Seen keys, without their records, are kept by bucket; a batch reads the buckets that its own keys fall into, and no record. Records
    without a key are left out.
    """
    kind = f"`{key}` {stream.schema[key].dataType.simpleString()}, batch int, bucket int"

    def keep(rows: DataFrame, number: int) -> None:
        rows.select(key, bucket_of(key, buckets).alias("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/keys/batch={number}")

    keep((seen if seen is not None else stream.sparkSession.createDataFrame([], stream.select(key).schema)).select(F.col(key).cast(stream.schema[key].dataType)).where(F.col(key).isNotNull()).distinct(), -1)

    def put(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = batch.where(F.col(key).isNotNull()).dropDuplicates([key]).withColumn("__b", bucket_of(key, buckets)).persist()
        try:
            touched = [r[0] for r in rows.select("__b").distinct().collect()]  # at most `buckets` numbers
            known = known_keys(session, path, kind).where(F.col("bucket").isin(touched) & (F.col("batch") < number)).select(F.col(key).alias("__k"), F.col("bucket").alias("__kb"))
            rows.join(known, (F.col(key) == F.col("__k")) & (F.col("__b") == F.col("__kb")), "left_anti").drop("__b").write.mode("overwrite").parquet(f"{path}/records/batch={number}")
            keep(session.read.schema(batch.schema).parquet(f"{path}/records/batch={number}"), number)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def known_keys(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The seen keys with their batch and bucket; both are folders, so filters on them choose what is read."""
    return spark.read.schema(schema).option("basePath", f"{path}/keys").parquet(f"{path}/keys")
