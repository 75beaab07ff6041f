"""Run facts of streams: audit rows from the progress of their micro-batches.

An ``AuditListener`` hears every micro-batch of the streams it is told about and
appends one audit row per micro-batch to a table: rows read, rows the stream
observed (``observed_rows``), rows the watermark dropped as late, and the
watermark.  It writes every ``flush`` micro-batches and when a stream ends, so it
holds a bounded number of facts.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierline.sinks.writers import write_table

OBSERVED = "tierline_rows"

STREAM_AUDIT = StructType([
    StructField("run_id", StringType()), StructField("table_name", StringType()), StructField("layer", StringType()),
    StructField("status", StringType()), StructField("batch_id", LongType()), StructField("rows_read", LongType()),
    StructField("rows_observed", LongType()), StructField("rows_late", LongType()), StructField("watermark", StringType())])


def observed_rows(df: DataFrame) -> DataFrame:
    """``df``, whose rows at this place of the plan the audit counts."""
    return df.observe(OBSERVED, F.count(F.lit(1)).alias("rows"))


class AuditListener(StreamingQueryListener):
    """Writes audit rows of named streams to the table at ``dest``.

    Use it as a context: streams started inside are heard, and their audit rows
    are written when it is left."""

    def __init__(self, spark: SparkSession, dest: str, tables: dict[str, tuple[str, str]], flush: int = 100) -> None:
        """``tables``: name of the stream -> (table, layer)."""
        self.spark, self.dest, self.tables, self.flush = spark, dest, tables, flush
        self.rows: list[tuple] = []
        self.running: set[str] = set()
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        if event.name in self.tables:
            with self.lock:
                self.running.add(str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name not in self.tables or not p.numInputRows:
            return
        seen = p.observedMetrics.get(OBSERVED)
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        table, layer = self.tables[p.name]
        with self.lock:
            self.rows.append((str(p.id), table, layer, "Succeeded", p.batchId, p.numInputRows, seen["rows"] if seen else None, late,
                              p.eventTime.get("watermark")))
            full = len(self.rows) >= self.flush
        if full:
            self.write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            if str(event.id) in self.running:
                self.running.discard(str(event.id))
                if event.exception:
                    self.rows.append((str(event.id), None, None, "Failed", None, None, None, None, None))

    def write(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            write_table(self.spark.createDataFrame(rows, STREAM_AUDIT).coalesce(1), self.dest, mode="append", count_rows=False)

    def __enter__(self) -> AuditListener:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        # Events arrive some time after their query has ended.
        end = time.time() + 60
        while self.running and time.time() < end:
            time.sleep(0.05)
        self.spark.streams.removeListener(self)
        self.write()
