"""Registered queries: Structured Streaming (STR-1..4) and its run facts.

Each runs a real streaming query (file source, ``availableNow`` trigger,
checkpoint under the session's checkpoint folder) over a table of the
dataset and reads the sink back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.operators.cleanse import INGEST_TS, SOURCE_FILE
from tierline.plans import views as V
from tierline.plans.registry import register
from tierline.session import scratch_path
from tierline.sources.readers import read_table
from tierline.streaming import pipelines as S
from tierline.streaming.audit import AuditListener, observed_rows

ALERT_DELAY = "1 hour"


def _schema(spark, d, name):
    return V.table(spark, d, name).schema


@register("stream_bronze", "STR-1, PRJ-1", "SELECT * FROM orders")
def q_stream_bronze(spark, d):
    dest, ck = scratch_path(spark, "stream-bronze"), scratch_path(spark, "ck-bronze")
    S.stream_to_bronze(spark, d, _schema(spark, d, "orders"), dest, ck, glob="orders.parquet")
    return spark.read.parquet(dest).drop(INGEST_TS, SOURCE_FILE)


@register("stream_dedup", "STR-2", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_stream_dedup(spark, d):
    src = S.read_stream(spark, d, _schema(spark, d, "lineitem"), glob="lineitem.parquet")
    out = S.stream_dedup(src, ["l_orderkey", "l_linenumber"], "l_shipdate", "30 days")
    dest, ck = scratch_path(spark, "stream-dedup"), scratch_path(spark, "ck-dedup")
    (out.writeStream.format("parquet").option("checkpointLocation", ck)
     .trigger(availableNow=True).start(dest).awaitTermination())
    # Which duplicate survives depends on arrival order; the key set does not.
    return spark.read.parquet(dest).select("l_orderkey", "l_linenumber")


@register("stream_rollup_closed", "STR-3, MON-1", V.with_views("log") + f"""
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       count(*) FILTER (WHERE failure) AS failures, count(*) AS events
FROM log GROUP BY 1, 2
HAVING time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour'
       <= (SELECT max(ts) FROM events) - INTERVAL '{ALERT_DELAY}'""")
def q_stream_rollup_closed(spark, d):
    src = S.read_stream(spark, d, _schema(spark, d, "events"), glob="events.parquet")
    log = src.select("ts", (F.col("event_type") == "error").alias("failure"))
    out = S.stream_alerts(log, "ts", ALERT_DELAY, "1 hour")
    dest, ck = scratch_path(spark, "stream-alerts"), scratch_path(spark, "ck-alerts")
    (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ck)
     .trigger(availableNow=True).start(dest).awaitTermination())
    return spark.read.parquet(dest)


_UPSERT_SQL = """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE c_acctbal - 1 END AS c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 2 = 0 THEN 1 + {last} ELSE 0 END AS seq
FROM customer"""


@register("stream_upsert", "STR-4, SNK-5", _UPSERT_SQL.format(last="0"))
def q_stream_upsert(spark, d):
    dest, ck = scratch_path(spark, "stream-gold"), scratch_path(spark, "ck-gold")
    c = V.table(spark, d, "customer")
    S.append_changes(c.withColumns({"c_acctbal": F.col("c_acctbal") - 1, "seq": F.lit(0)}), dest, "initial", 0)
    src = S.read_stream(spark, d, _schema(spark, d, "customer"), glob="customer.parquet")
    S.stream_upsert(src.filter(F.col("c_custkey") % 2 == 0).withColumn("seq", F.lit(1)), dest, ck)
    return S.current_state(spark, dest, ["c_custkey"], ["seq"])


@register("stream_upsert_again", "STR-4, SNK-5", _UPSERT_SQL.format(last="2"))
def q_stream_upsert_again(spark, d):
    """Repeated keys in one batch, a second batch, and a fresh checkpoint."""
    dest = scratch_path(spark, "stream-gold2")
    c = V.table(spark, d, "customer")
    S.append_changes(c.withColumns({"c_acctbal": F.col("c_acctbal") - 1, "seq": F.lit(0)}), dest, "initial", 0)
    src = S.read_stream(spark, d, _schema(spark, d, "customer"), glob="customer.parquet").filter(F.col("c_custkey") % 2 == 0)
    twice = F.explode(F.array(F.struct(F.lit(1).alias("seq"), (F.col("c_acctbal") + 5).alias("b")),
                              F.struct(F.lit(2).alias("seq"), (F.col("c_acctbal") + 7).alias("b"))))
    first = src.select("*", twice.alias("x")).withColumns({"c_acctbal": F.col("x.b"), "seq": F.col("x.seq")}).drop("x")
    S.stream_upsert(first, dest, scratch_path(spark, "ck-a"))
    S.stream_upsert(src.withColumn("seq", F.lit(3)), dest, scratch_path(spark, "ck-b"))
    return S.current_state(spark, dest, ["c_custkey"], ["seq"])


@register("stream_upsert_folded", "STR-4, SNK-5", _UPSERT_SQL.format(last="3"))
def q_stream_upsert_folded(spark, d):
    """Three batches with two folds between them: the state is the bucketed
    base joined with the changes that are not folded yet."""
    dest = scratch_path(spark, "stream-folded")
    base = "tierline_base_" + dest.rsplit("-", 1)[1]
    c = V.table(spark, d, "customer")
    S.append_changes(c.withColumns({"c_acctbal": F.col("c_acctbal") - 1, "seq": F.lit(0)}), dest, "initial", 0)
    src = S.read_stream(spark, d, _schema(spark, d, "customer"), glob="customer.parquet").filter(F.col("c_custkey") % 2 == 0)
    for seq in (4, 2, 1):                        # the first batch stays the latest
        S.stream_upsert(src.withColumn("c_acctbal", F.col("c_acctbal") + F.lit(4 - seq)).withColumn("seq", F.lit(seq)), dest, scratch_path(spark, f"ck-{seq}"))
        if seq != 1:
            S.fold_changes(spark, dest, base, ["c_custkey"], ["seq"], buckets=8, settled=0)
    return S.current_state(spark, dest, ["c_custkey"], ["seq"], base=base)


@register("stream_usage_alerts", "STR-3, MON-2", V.with_views("log") + """
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
       time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end, resource,
       CAST(SUM(CAST(usage AS DECIMAL(28,9))) AS DOUBLE) AS total_usage
FROM log GROUP BY 1, 2, 3
HAVING CAST(SUM(CAST(usage AS DECIMAL(28,9))) AS DOUBLE) > 5000
   AND time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day'
       <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'""")
def q_stream_usage_alerts(spark, d):
    src = S.read_stream(spark, d, _schema(spark, d, "events"), glob="events.parquet")
    log = src.select("ts", F.col("event_type").alias("resource"), F.col("value").alias("usage"))
    out = S.stream_usage_alerts(log, "ts", "1 hour")
    dest, ck = scratch_path(spark, "stream-usage"), scratch_path(spark, "ck-usage")
    (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ck)
     .trigger(availableNow=True).start(dest).awaitTermination())
    return spark.read.parquet(dest)


# The second file of the audited stream holds all events, so those up to the
# first file's watermark come late.
AUDIT_SPLIT = "2024-01-20 00:00:00"


@register("stream_audit", "STR-1, STR-3, SNK-12, VAL-1", f"""
WITH first AS (SELECT * FROM events WHERE ts < TIMESTAMP '{AUDIT_SPLIT}'),
mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '1 day' AS wm FROM first),
second AS (SELECT * FROM events)
SELECT 'bronze.events' AS table_name, 'Succeeded' AS status, (SELECT count(*) FROM first) AS rows_read,
       (SELECT count(*) FROM first) AS rows_observed, 0::BIGINT AS rows_late
UNION ALL SELECT 'bronze.events', 'Succeeded', (SELECT count(*) FROM second), (SELECT count(*) FROM second),
       (SELECT count(*) FROM second, mark WHERE ts <= wm)""")
def q_stream_audit(spark, d):
    """The audit rows of a stream of two micro-batches, late rows included."""
    root, ev = scratch_path(spark, "audited-events"), V.table(spark, d, "events")
    audit, dest, ck = (scratch_path(spark, n) for n in ("stream-audit", "audited-sink", "ck-audit"))
    name = "audited_" + audit.rsplit("-", 1)[1]
    with AuditListener(spark, audit, {name: ("bronze.events", "bronze")}):
        for part, rows in (("a", ev.filter(F.col("ts") < F.lit(AUDIT_SPLIT).cast("timestamp_ntz"))), ("b", ev)):
            rows.write.parquet(f"{root}/{part}")
            src = observed_rows(S.read_stream(spark, f"{root}/*", ev.schema))
            (S.stream_dedup(src, ["event_id"], "ts", "1 day", reduce=False).writeStream.queryName(name).format("parquet")
             .option("checkpointLocation", ck).trigger(availableNow=True).start(dest).awaitTermination())
    return read_table(spark, audit).select("table_name", "status", "rows_read", "rows_observed", "rows_late")


@register("stream_dedup_hot", "STR-2", """
SELECT l_orderkey % 3 = 0 AS hot, CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k,
       CASE WHEN l_orderkey % 3 = 0 THEN max(l_linenumber) END AS hot_line
FROM lineitem GROUP BY 1, 2, l_orderkey % 3 = 0""")
def q_stream_dedup_hot(spark, d):
    """A third of the rows share one key; every task sends one row of it.  The
    event time follows the line number, so the hot key's latest row is known."""
    src = S.read_stream(spark, d, _schema(spark, d, "lineitem"), glob="lineitem.parquet")
    hot = F.col("l_orderkey") % 3 == 0
    rows = src.select(hot.alias("hot"), F.when(hot, F.lit(0)).otherwise(F.col("l_orderkey")).cast("bigint").alias("k"), "l_linenumber",
                      F.timestamp_seconds(F.col("l_linenumber")).alias("ts"))
    dest, ck = scratch_path(spark, "stream-hot"), scratch_path(spark, "ck-hot")
    (S.stream_dedup(rows, ["k"], "ts", "30 days").writeStream.format("parquet").option("checkpointLocation", ck)
     .trigger(availableNow=True).start(dest).awaitTermination())
    return read_table(spark, dest).select("hot", "k", F.when(F.col("hot"), F.col("l_linenumber")).alias("hot_line"))
