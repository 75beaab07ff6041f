"""Structured Streaming forms of the layer jobs.

* ``stream_to_bronze``  file source -> bronze table, each file exactly once
                        (the checkpoint records processed files and offsets)
* ``stream_dedup``      one row per key within the event-time watermark
* ``stream_alerts``     tumbling-window counts/sums emitted once a window
                        is closed by the watermark (append mode)
* ``stream_upsert``     micro-batches appended to a change table, whose latest
                        row per key is the current state; ``fold_changes`` moves
                        settled epochs into a bucketed base table

Checkpoints and outputs must live on shared storage; a restarted query
resumes from its checkpoint, so lost executors or drivers replay only the
unfinished micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tierline.functions.keys import key_text
from tierline.operators.cleanse import INGEST_TS, SOURCE_FILE
from tierline.operators.dedup import dedup_latest, orderable
from tierline.sinks.replace import drop_directory, replace_bucketed
from tierline.sinks.writers import stored_schema
from tierline.sources.readers import read_options

STREAM_COL, EPOCH_COL, KEY_COL = "_stream", "_epoch", "_key"
NO_TIME = -(1 << 63)


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None, **opts) -> DataFrame:
    """A file-source stream with the batch reader's per-format options."""
    o = read_options(fmt, **opts)
    o.pop("inferSchema", None)
    o.pop("mergeSchema", None)
    if glob:
        o["pathGlobFilter"] = glob
    if max_files_per_trigger:
        o["maxFilesPerTrigger"] = str(max_files_per_trigger)
    return spark.readStream.format(fmt).options(**o).schema(schema).load(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; timestamp-without-zone columns are cast."""
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def stream_to_bronze(spark: SparkSession, source: str, schema: StructType | str, dest: str,
                     checkpoint: str, fmt: str = "parquet", glob: str | None = None,
                     partition_by: Sequence[str] = (), ingest_ts=None, wait: bool = True):
    """Ingest every new file under ``source`` into the Parquet table at
    ``dest`` with ingest metadata; runs as ``availableNow`` (process what is
    there, then stop), so it can be scheduled like a batch job."""
    df = read_stream(spark, source, schema, fmt, glob)
    stamp = F.current_timestamp() if ingest_ts is None else F.lit(ingest_ts).cast("timestamp")
    df = df.withColumn(INGEST_TS, stamp).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    w = (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(dest)
    if wait:
        q.awaitTermination()
    return q


def stream_dedup(df: DataFrame, keys: Sequence[str], ts: str, delay: str, reduce: bool = True) -> DataFrame:
    """One row per key among rows no later than ``delay`` behind the newest
    event; the state for a key is dropped once the watermark passes it (bounded
    state).  A later micro-batch cannot replace a row already emitted in append
    mode; within a micro-batch the latest row of a task is kept.

    With ``reduce`` every task first keeps one row per key, so a key with a large
    share of the rows reaches its state task as one row per task."""
    df = event_time(df, ts)
    if reduce:
        df = latest_per_task(df, keys, ts)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def latest_per_task(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Per task and key the row with the greatest ``ts`` (nulls least; of equal
    ones the first), without a shuffle.  A task holds one row per key; rows are
    reduced whenever as many have arrived as are held."""
    key = fresh_name("__key", df)
    names = [*df.columns]

    def reduced(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        order = pd.DataFrame({"k": t.column(key).to_pandas(), "t": t.column(ts).cast(pa.int64()).fill_null(NO_TIME).to_numpy()})
        rows = order.sort_values("t", ascending=False, kind="stable").drop_duplicates("k").index.sort_values()
        return t.take(pa.array(rows.to_numpy())).combine_chunks().to_batches(max_chunksize=max(1, len(rows)))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept, new = [], 0, 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                new += b.num_rows
            if new > max(kept, 50_000):
                held, new = [reduced(held)], 0
                kept = held[0].num_rows
        if held:
            out = reduced(held)
            for at in range(0, out.num_rows, 10_000):
                part = out.slice(at, 10_000)
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names], names)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.withColumn(key, key_text([F.col(k) for k in keys])).mapInArrow(run, ddl)


def fresh_name(name: str, df: DataFrame) -> str:
    while name in df.columns:
        name += "_"
    return name


def use_rocksdb_state(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB (off the heap)
    and checkpoint its changes only, instead of whole snapshots."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def stream_alerts(df: DataFrame, ts: str, delay: str, window: str, by: Sequence[str] = (),
                  aggs: Sequence | None = None) -> DataFrame:
    """Tumbling-window aggregates emitted once the watermark closes the
    window (append mode); default aggregates: failures (``failure``) and rows.
    Window bounds come back as timestamps without zone."""
    df = event_time(df, ts)
    aggs = aggs or [F.count_if(F.col("failure")).alias("failures"), F.count(F.lit(1)).alias("events")]
    out = df.withWatermark(ts, delay).groupBy(F.window(ts, window), *by).agg(*aggs)
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                      *[c for c in out.columns if c != "window"])


def stream_usage_alerts(df: DataFrame, ts: str, delay: str, resource: str = "resource",
                        usage: str = "usage", window: str = "1 day", threshold: float = 5000) -> DataFrame:
    """Streaming form of the usage alert: per closed window and resource,
    the exact usage total, emitted only when above ``threshold``."""
    from tierline.functions.money import exact_sum
    out = stream_alerts(df, ts, delay, window, by=[resource], aggs=[exact_sum(usage).alias("total_usage")])
    return out.filter(F.col("total_usage") > threshold)


def append_changes(batch: DataFrame, dest: str, stream: str, epoch: int) -> None:
    """Append a batch of rows to the change table at ``dest`` under its
    (stream, epoch) partition.  A retried epoch replaces its own partition
    and nothing else, whatever other streams or checkpoints have written."""
    (batch.withColumn(STREAM_COL, F.lit(stream)).withColumn(EPOCH_COL, F.lit(int(epoch)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(STREAM_COL, EPOCH_COL).parquet(dest))


def read_changes(spark: SparkSession, dest: str) -> DataFrame | None:
    """The change table at ``dest``, or None while it has no rows."""
    schema = stored_schema(spark, dest)
    if schema is None:
        return None
    kinds = {STREAM_COL: StringType(), EPOCH_COL: LongType()}       # partition columns as written
    schema = StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in schema.fields])
    return spark.read.schema(schema).parquet(dest)


def current_state(spark: SparkSession, dest: str, keys: Sequence[str], order_by: Sequence[str], base: str | None = None) -> DataFrame:
    """The table that the changes at ``dest`` make up: per key the row with
    the greatest ``order_by`` (ties: the later epoch, then the greatest row).

    With ``base`` (a table that ``fold_changes`` keeps) only the changes that
    are not folded yet are reduced, and joined with the base on its buckets,
    which are not shuffled."""
    return latest_with_base(spark, dest, keys, order_by, base, read_changes(spark, dest)).drop(STREAM_COL, EPOCH_COL, KEY_COL)


def latest_with_base(spark: SparkSession, dest: str, keys: Sequence[str], order_by: Sequence[str], base: str | None,
                     changes: DataFrame | None) -> DataFrame:
    """Per key the latest row of the base and ``changes``, with ``KEY_COL``."""
    folded = spark.table(base) if base and spark.catalog.tableExists(base) else None
    if changes is None and folded is None:
        raise ValueError(f"no rows at {dest}")
    if changes is not None:
        changes = dedup_latest(changes, keys, order_by, ties=[EPOCH_COL]).withColumn(KEY_COL, key_text([F.col(k) for k in keys]))
    if folded is None or changes is None:
        return changes if folded is None else folded
    both = folded.limit(0).unionByName(changes.limit(0), allowMissingColumns=True).schema
    old, new = (df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in both.fields])
                for df in (folded, changes))
    first = [*order_by, EPOCH_COL]
    rest = [f.name for f in both.fields if f.name not in {*first, *keys, KEY_COL, STREAM_COL} and orderable(f.dataType)]

    def side(df: DataFrame, name: str) -> DataFrame:
        rank = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate([*first, *rest])])
        return df.select(F.col(KEY_COL).alias(f"{name}_key"), rank.alias(f"{name}_rank"), F.struct(*[f"`{c}`" for c in df.columns]).alias(name))

    j = side(old, "old").join(side(new, "new"), F.col("old_key") == F.col("new_key"), "full_outer")
    # A struct's nulls are its least values, as in the descending order of dedup_latest.
    wins = F.col("old_key").isNull() | (F.col("new_rank") >= F.col("old_rank"))
    return j.select(F.when(F.coalesce(wins, F.lit(False)), F.col("new")).otherwise(F.col("old")).alias("r")).select("r.*")


def fold_changes(spark: SparkSession, dest: str, base: str, keys: Sequence[str], order_by: Sequence[str],
                 buckets: int = 64, settled: int = 1) -> int:
    """Folds the settled epochs of the change table into the catalog table
    ``base``, bucketed by key, and takes them out of the change table; returns
    their number.  The last ``settled`` epochs of every stream stay, as a retry
    may still replace them.

    The base is swapped in whole (``tierline.sinks.replace``) before the epochs
    go; an epoch that is in both for a while, or after a fold that was cut
    short, changes no result."""
    changes = read_changes(spark, dest)
    if changes is None:
        return 0
    epochs: dict[str, list[int]] = {}
    for stream, epoch in changes.select(STREAM_COL, EPOCH_COL).distinct().collect():
        epochs.setdefault(stream, []).append(epoch)
    done = {s: sorted(e)[:len(e) - settled] for s, e in epochs.items() if len(e) > settled}
    if not done:
        return 0
    mine = F.lit(False)
    for s, e in sorted(done.items()):
        mine = mine | ((F.col(STREAM_COL) == s) & (F.col(EPOCH_COL) <= e[-1]))
    replace_bucketed(latest_with_base(spark, dest, keys, order_by, base, changes.filter(mine)), base, buckets, [KEY_COL])
    for s, e in done.items():
        for epoch in e:
            drop_directory(spark, f"{dest}/{STREAM_COL}={s}/{EPOCH_COL}={epoch}")
    spark.catalog.refreshByPath(dest)
    return sum(map(len, done.values()))


def stream_upsert(df: DataFrame, dest: str, checkpoint: str,
                  prepare: Callable[[DataFrame], DataFrame] | None = None, wait: bool = True):
    """Upsert a stream of rows: every micro-batch is appended to the change
    table at ``dest``; ``current_state`` reads the latest row per key by the
    rows' own order columns, so neither the order of batches nor a restart
    from a fresh checkpoint can lose an update.  Each checkpoint is a stream
    of its own (the query id that Spark keeps in it)."""
    def run(batch: DataFrame, epoch: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("no streaming query id: call this from foreachBatch")
        append_changes(prepare(batch) if prepare else batch, dest, stream, epoch)

    q = (df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q
