"""Streaming behaviour: exactly-once file ingest across runs, late data,
idempotent micro-batch upserts."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tierline.streaming import pipelines as S

from conftest import SF_SMALL


def test_bronze_stream_ingests_each_file_once(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src, dest, ck = tmp_dir + "/src", tmp_dir + "/dest", tmp_dir + "/ck"
    ev.filter(F.col("event_id") < 500).write.parquet(src + "/a")
    flat = src + "/flat"
    os.makedirs(flat)
    for name in os.listdir(src + "/a"):
        if name.endswith(".parquet"):
            os.rename(os.path.join(src, "a", name), os.path.join(flat, "a-" + name))
    S.stream_to_bronze(spark, flat, ev.schema, dest, ck, ingest_ts="2024-01-01 00:00:00")
    assert spark.read.parquet(dest).count() == 500
    # A second file lands; only it is read on the next run.
    ev.filter(F.col("event_id") >= 500).write.parquet(src + "/b")
    for name in os.listdir(src + "/b"):
        if name.endswith(".parquet"):
            os.rename(os.path.join(src, "b", name), os.path.join(flat, "b-" + name))
    S.stream_to_bronze(spark, flat, ev.schema, dest, ck, ingest_ts="2024-01-01 00:00:00")
    out = spark.read.parquet(dest)
    assert out.count() == ev.count()
    assert out.select("event_id").distinct().count() == ev.count()
    assert out.filter(F.col("_source_file").contains("/b-")).count() == ev.count() - 500


def test_alerts_ignore_rows_behind_the_watermark(spark, tmp_dir):
    schema = "ts timestamp_ntz, failure boolean"
    base = dt.datetime(2024, 1, 1)
    first = [(base + dt.timedelta(minutes=10 * i), i % 2 == 0) for i in range(30)]   # 0:00 .. 4:50
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(tmp_dir + "/in/b1")
    src = S.read_stream(spark, tmp_dir + "/in", schema, recursiveFileLookup="true", max_files_per_trigger=1)
    out = S.stream_alerts(src, "ts", "1 hour", "1 hour")
    q = (out.writeStream.format("parquet").option("checkpointLocation", tmp_dir + "/ck")
         .outputMode("append").start(tmp_dir + "/out"))
    q.processAllAvailable()
    # Watermark is now 3:50.  A row for 0:30 is too late; one for 4:05 is on time.
    late = [(base + dt.timedelta(minutes=30), True), (base + dt.timedelta(hours=4, minutes=5), True),
            (base + dt.timedelta(hours=9), False)]
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(tmp_dir + "/in/b2")
    q.processAllAvailable()
    q.stop()
    got = {r["window_start"]: (r["failures"], r["events"]) for r in spark.read.parquet(tmp_dir + "/out").collect()}
    assert got[base] == (3, 6)                                   # the 0:30 row was dropped
    assert got[base + dt.timedelta(hours=4)] == (4, 7)           # the 4:05 row counted


def _state(spark, dest):
    return sorted(tuple(r) for r in S.current_state(spark, dest, ["k"], ["seq"]).select("k", "v").collect())


def test_upsert_epoch_rerun_is_idempotent(spark, tmp_dir):
    dest, kind = tmp_dir + "/gold", "k int, v string, seq int"
    S.append_changes(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], kind), dest, "initial", 0)
    batch = spark.createDataFrame([(2, "B", 1), (3, "c", 1)], kind)
    S.append_changes(batch, dest, "s1", 0)
    first = _state(spark, dest)
    S.append_changes(batch, dest, "s1", 0)                     # a retried epoch
    assert _state(spark, dest) == first == [(1, "a"), (2, "B"), (3, "c")]
    S.append_changes(spark.createDataFrame([(1, "A", 2)], kind), dest, "s1", 1)
    assert _state(spark, dest) == [(1, "A"), (2, "B"), (3, "c")]


def test_upsert_survives_a_fresh_checkpoint_and_repeated_keys(spark, tmp_dir):
    """Two runs with one checkpoint, a third with a new one (its epochs start
    at 0 again); one batch holds a key twice; late rows do not win."""
    dest, kind = tmp_dir + "/gold", "k int, v string, seq int"

    def load(name, rows, ck):
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_dir}/in-{ck}/{name}")
        S.stream_upsert(S.read_stream(spark, f"{tmp_dir}/in-{ck}/*", kind), dest, f"{tmp_dir}/ck-{ck}")

    load("b1", [(1, "one", 1), (1, "uno", 2), (2, "two", 1)], "a")
    load("b2", [(2, "zwei", 5)], "a")
    load("b3", [(1, "eins", 9), (3, "drei", 1), (2, "late", 4)], "b")
    assert _state(spark, dest) == [(1, "eins"), (2, "zwei"), (3, "drei")]


def test_stream_dedup_drops_repeats(spark, tmp_dir):
    schema = "k int, ts timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, t), (1, t + dt.timedelta(minutes=1)), (2, t)], schema).write.parquet(tmp_dir + "/in")
    src = S.read_stream(spark, tmp_dir + "/in", schema)
    out = S.stream_dedup(src, ["k"], "ts", "10 minutes")
    q = (out.writeStream.format("parquet").option("checkpointLocation", tmp_dir + "/ck")
         .trigger(availableNow=True).start(tmp_dir + "/out"))
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(tmp_dir + "/out").collect()) == [1, 2]
