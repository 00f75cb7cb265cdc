"""Streams that are stopped, started again, replayed, and fed late and repeated events."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tallyfield.streaming import keyed as K
from tallyfield.streaming import lifecycle as L

SCHEMA = "event_id long, key string, kind string, ts timestamp"


@pytest.fixture
def keyed_state(spark):
    for k, v in K.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k in K.STATE_STORE:
        spark.conf.unset(k)


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def land(spark, folder, rows, schema=SCHEMA):
    """One file more in the folder, as one micro-batch takes it."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(0.05)  # files are taken in order of their times


def source(spark, folder, schema=SCHEMA):
    os.makedirs(folder, exist_ok=True)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def forget_last_commit(checkpoint):
    """As if the run had died after its batch was written and before it was marked as done."""
    done = sorted((int(x) for x in os.listdir(f"{checkpoint}/commits") if x.isdigit()))
    os.remove(f"{checkpoint}/commits/{done[-1]}")
    crc = f"{checkpoint}/commits/.{done[-1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)


FIRST = [(1, "A", "sent", at(2)), (2, "A", "responded", at(5)), (3, "B", "sent", at(3)), (4, "C", "odd", at(1))]
SECOND = [(5, "B", "bounced", at(4)), (6, "B", "responded", at(6)), (2, "A", "responded", at(5)), (7, "A", "draft_ready", at(1)), (7, "A", "draft_ready", at(1))]  # late and repeated
THIRD = [(8, "D", "sent", at(9)), (3, "B", "sent", at(3)), (9, "A", "sent", at(1, 5))]


def test_lifecycle_stream_with_restarts_equals_the_batch_fold(spark, tmp_path, keyed_state):
    run = lambda: K.lifecycle_stream(source(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), "key", "event_id").awaitTermination(180)
    columns = ["key", "status", "n_events", *K.DATES]
    rows = []
    for part in (FIRST, SECOND, THIRD):
        land(spark, tmp_path / "in", part)
        rows += part
        assert run()
        want = L.fold(spark.createDataFrame(rows, SCHEMA).dropDuplicates(["event_id"]), "key").select(columns)
        table = lambda: sorted(map(str, K.lifecycle_table(spark, str(tmp_path / "out")).select(columns).collect()))
        assert table() == sorted(map(str, want.collect()))
        forget_last_commit(tmp_path / "cp")
        assert run() and table() == sorted(map(str, want.collect()))  # the batch ran again and left nothing twice
    K.compact(spark, str(tmp_path / "out"), 2)
    assert table() == sorted(map(str, want.collect()))
    K.compact(spark, str(tmp_path / "out"), 2)
    assert table() == sorted(map(str, want.collect())) and K.current_version(spark, str(tmp_path / "out" / "base")) == 2


def test_lifecycle_state_is_forgotten(spark, tmp_path, keyed_state):
    folder, out = tmp_path / "in", tmp_path / "out"
    run = lambda: K.lifecycle_stream(source(spark, folder), str(out), str(tmp_path / "cp"), "key", "event_id", remember=1000, idle=1000)
    land(spark, folder, FIRST)
    q = run()
    assert q.awaitTermination(180) and q.lastProgress.stateOperators[0].numRowsTotal > 0
    time.sleep(2)
    land(spark, folder, [(20, "Z", "sent", at(20))])
    q = run()
    assert q.awaitTermination(180)
    # what the first events left in the state is gone: the fold of an old key starts anew, and the table still holds what was written
    land(spark, folder, [(21, "A", "draft_ready", at(21))])
    assert run().awaitTermination(180)
    last = sorted(os.listdir(out / "changes"), key=lambda x: int(x.split("=")[1]) if "=" in x else -1)[-1]
    assert [(x.key, x.status) for x in spark.read.parquet(str(out / "changes" / last)).collect()] == [("A", "draft_ready")]
    assert {x.key: x.status for x in K.lifecycle_table(spark, str(out)).collect()} == {"A": "responded", "B": "sent", "Z": "sent"}


def test_new_records_once_whatever_runs_again(spark, tmp_path):
    seen = spark.createDataFrame([(1,), (77,)], "event_id long")
    run = lambda: K.new_records(source(spark, tmp_path / "in"), "event_id", str(tmp_path / "out"), str(tmp_path / "cp"), seen, buckets=16).awaitTermination(180)
    ids = lambda: sorted(x.event_id for x in spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(str(tmp_path / "out" / "records")).collect())
    land(spark, tmp_path / "in", [*FIRST, (3, "B", "sent", at(3)), (None, "X", "sent", at(3))])
    assert run() and ids() == [2, 3, 4]
    land(spark, tmp_path / "in", SECOND)
    assert run() and ids() == [2, 3, 4, 5, 6, 7]
    forget_last_commit(tmp_path / "cp")
    assert run() and ids() == [2, 3, 4, 5, 6, 7]
    land(spark, tmp_path / "in", THIRD)
    assert run() and ids() == [2, 3, 4, 5, 6, 7, 8, 9]
    # a filter on buckets chooses files
    keys = K.known_keys(spark, str(tmp_path / "out"), "event_id long, batch int, bucket int")
    one = keys.where(F.col("bucket").isin([keys.first()["bucket"]]))
    assert len(set(x[0] for x in one.select(F.input_file_name()).collect())) < len(set(x[0] for x in keys.select(F.input_file_name()).collect()))


def test_sessions_of_a_stream_with_late_events(spark, tmp_path):
    stream = L.sessions(source(spark, tmp_path / "in"), "key", "ts", "1 hour", "2 hours").writeStream.outputMode("append").format("parquet")
    run = lambda: stream.option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    land(spark, tmp_path / "in", [(1, "A", "x", at(1, 0)), (2, "A", "x", at(1, 0, 30)), (3, "B", "x", at(1, 1))])
    land(spark, tmp_path / "in", [(4, "A", "x", at(1, 1, 10)), (5, "B", "x", at(1, 8))])  # late, but within the delay: it lengthens A's session
    land(spark, tmp_path / "in", [(8, "C", "x", at(1, 8))])  # a watermark holds from the batch after next on
    land(spark, tmp_path / "in", [(6, "A", "x", at(1, 0, 45)), (7, "B", "x", at(2, 8))])  # too late for A
    q = run()
    assert q.awaitTermination(180)
    got = sorted((x.key, x.session_start, x.session_end, x.n) for x in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("A", at(1, 0), at(1, 2, 10), 3), ("B", at(1, 1), at(1, 2), 1), ("B", at(1, 8), at(1, 9), 1), ("C", at(1, 8), at(1, 9), 1)]
    assert q.lastProgress.stateOperators[0].numRowsTotal == 1  # only the last session is still open


def test_repeats_within_the_delay_and_dropped_state(spark, tmp_path):
    stream = L.deduplicated(source(spark, tmp_path / "in"), "event_id", "ts", "1 hour").writeStream.outputMode("append").format("parquet")
    run = lambda: stream.option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    ids = lambda: sorted(x.event_id for x in spark.read.parquet(str(tmp_path / "out")).collect())
    land(spark, tmp_path / "in", [(1, "A", "x", at(1, 0)), (1, "A", "x", at(1, 0, 5)), (2, "A", "x", at(1, 0))])
    assert run().awaitTermination(180) and ids() == [1, 2]
    land(spark, tmp_path / "in", [(2, "A", "x", at(1, 0, 50)), (3, "A", "x", at(1, 9))])  # a repeat after a restart
    assert run().awaitTermination(180) and ids() == [1, 2, 3]
    land(spark, tmp_path / "in", [(4, "A", "x", at(1, 0)), (5, "A", "x", at(2, 9))])  # 4 is too late
    q = run()
    assert q.awaitTermination(180) and ids() == [1, 2, 3, 5]
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in q.recentProgress) >= 1 and q.lastProgress.stateOperators[0].numRowsTotal <= 2


def test_funnel_of_a_stream(spark, tmp_path):
    stream = L.funnel_by_window(source(spark, tmp_path / "in"), "kind", "ts", "1 day", "12 hours", "1 hour").writeStream.outputMode("append").format("parquet")
    run = lambda: stream.option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    land(spark, tmp_path / "in", [(1, "A", "sent", at(1, 1)), (2, "A", "sent", at(1, 13))])
    land(spark, tmp_path / "in", [(3, "A", "sent", at(9))])
    assert run().awaitTermination(180)
    got = sorted((x.window_start, x.n) for x in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(dt.datetime(2023, 12, 31, 12), 1), (at(1, 0), 2), (at(1, 12), 1)]
