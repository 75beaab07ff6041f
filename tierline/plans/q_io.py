"""Registered queries: sources, incremental loads, sinks, upsert and diff
(SRC-*, SNK-1..5, SNK-10..12, VAL-1/2).

Round trips write under the session's checkpoint folder (a shared folder on
a cluster) and read the written data back.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StructField, StructType

from tierline.operators.changefeed import change_feed, store_snapshot
from tierline.operators.cleanse import enforce_schema
from tierline.operators.merge import snapshot_diff, upsert
from tierline.plans import views as V
from tierline.plans.registry import register
from tierline.session import scratch_path
from tierline.sinks.writers import audit_row, evolve_append, write_csv, write_table
from tierline.sources import incremental as I
from tierline.sources.footers import footer_aggregates
from tierline.sources.readers import read_landing, read_source, read_table

TARGET_CUTOFF = "2001-01-01"


def _bronze_target(spark, d):
    """The already-loaded target: orders up to the cut-off date."""
    return V.orders_hdr(spark, d).filter(F.col("order_date") <= F.lit(TARGET_CUTOFF).cast("timestamp_ntz"))


_WM_SQL = f"(SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '{TARGET_CUTOFF}')"


@register("high_watermark", "SRC-10, AGG-7", f"""
SELECT max(o_orderdate) AS max_watermark FROM orders WHERE o_orderdate <= TIMESTAMP '{TARGET_CUTOFF}'""")
def q_high_watermark(spark, d):
    """Of a stored target; a timestamp has no statistics Spark would push down."""
    target = _stored_target(spark, d, _bronze_target(spark, d))
    kind = target.schema["order_date"].dataType
    wm = I.high_watermark(target, "order_date", stored=True)
    return spark.createDataFrame([(wm,)], StructType([StructField("max_watermark", kind)]))


def _stored_target(spark, d, target):
    path = scratch_path(spark, "target")
    write_table(target, path)
    return read_table(spark, path)


FOOTER_FACTS = {"row_count": ("count", None), "max_order_date": ("max", "order_date"), "min_order_id": ("min", "order_id"),
                "max_total": ("max", "total_amount")}


@register("footer_watermark", "SRC-10, VAL-1, AGG-4, AGG-7, AGG-10", f"""
SELECT count(*) AS row_count, max(CAST(o_orderdate AS DATE)) AS max_order_date, min(o_orderkey) AS min_order_id,
       max(o_totalprice) AS max_total FROM orders WHERE o_orderdate <= TIMESTAMP '{TARGET_CUTOFF}'""")
def q_footer_watermark(spark, d):
    """Watermark and counts of a stored target from its file footers."""
    stored = _stored_target(spark, d, _bronze_target(spark, d).withColumn("order_date", F.to_date("order_date")))
    facts = footer_aggregates(stored, FOOTER_FACTS)
    kinds = {"row_count": LongType(), "max_order_date": DateType(), "min_order_id": stored.schema["order_id"].dataType, "max_total": DoubleType()}
    return spark.createDataFrame([tuple(facts[n] for n in kinds)], StructType([StructField(n, k) for n, k in kinds.items()]))


@register("incremental_load", "SRC-11, FLT-4", V.with_views("orders_hdr") + f"""
SELECT * FROM orders_hdr WHERE order_date > {_WM_SQL}""")
def q_incremental_load(spark, d):
    wm = I.high_watermark(_bronze_target(spark, d), "order_date")
    return I.incremental(V.orders_hdr(spark, d), "order_date", wm)


@register("slice_window", "SRC-12", """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""")
def q_slice_window(spark, d):
    return I.slice_window(V.table(spark, d, "events"), "ts",
                          _dt.datetime(2024, 1, 10), _dt.datetime(2024, 1, 20))


@register("new_rows", "VAL-2", f"""
SELECT count(*) AS new_records FROM orders WHERE o_orderdate > {_WM_SQL}""")
def q_new_rows(spark, d):
    wm = I.high_watermark(_bronze_target(spark, d), "order_date")
    return I.new_rows(V.orders_hdr(spark, d), "order_date", wm)


@register("table_counts", "VAL-1, AGG-4, AGG-10", """
SELECT 'lineitem' AS "table", count(*) AS row_count FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'customer', count(*) FROM customer""")
def q_table_counts(spark, d):
    return I.table_counts({t: V.table(spark, d, t) for t in ("lineitem", "orders", "part", "customer")})


# Update batch derived from customer: every 10th key with a new balance and
# five new keys (copies of the first five customers under fresh keys).
NEW_KEY_OFFSET = 10_000_000


def _updates(spark, d):
    c = V.table(spark, d, "customer")
    changed = c.filter(F.col("c_custkey") % 10 == 0).withColumn(
        "c_acctbal", (F.col("c_acctbal") + 100).cast("double"))
    fresh = c.filter(F.col("c_custkey") <= 5).withColumn(
        "c_custkey", F.col("c_custkey") + NEW_KEY_OFFSET)
    return changed.unionByName(fresh)


_UPDATES_SQL = f"""updates AS (
  SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal + 100 AS DOUBLE) AS c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 10 = 0
  UNION ALL
  SELECT c_custkey + {NEW_KEY_OFFSET}, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey <= 5)"""


@register("upsert", "SNK-5, JOIN-4", f"""WITH {_UPDATES_SQL}
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM updates)
UNION ALL SELECT * FROM updates""")
def q_upsert(spark, d):
    return upsert(V.table(spark, d, "customer"), _updates(spark, d), ["c_custkey"])


@register("snapshot_diff", "SNK-11, JOIN-4", f"""WITH {_UPDATES_SQL},
new_snap AS (
  SELECT * FROM (
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM updates)
    UNION ALL SELECT * FROM updates)
  WHERE c_custkey % 25 <> 0 OR c_custkey % 10 = 0),
j AS (
  SELECT o.c_custkey AS ok, n.c_custkey AS nk,
         o.c_name AS on_, o.c_nationkey AS onk, o.c_acctbal AS oab, o.c_mktsegment AS oms,
         n.c_name AS nn, n.c_nationkey AS nnk, n.c_acctbal AS nab, n.c_mktsegment AS nms
  FROM customer o FULL OUTER JOIN new_snap n ON o.c_custkey = n.c_custkey)
SELECT ok AS c_custkey, on_ AS c_name, onk AS c_nationkey, oab AS c_acctbal, oms AS c_mktsegment,
       'delete' AS _change_type FROM j WHERE nk IS NULL
UNION ALL
SELECT nk, nn, nnk, nab, nms, 'insert' FROM j WHERE ok IS NULL
UNION ALL
SELECT ok, on_, onk, oab, oms, 'update_preimage' FROM j
WHERE ok IS NOT NULL AND nk IS NOT NULL AND
      (on_ IS DISTINCT FROM nn OR onk IS DISTINCT FROM nnk OR oab IS DISTINCT FROM nab OR oms IS DISTINCT FROM nms)
UNION ALL
SELECT nk, nn, nnk, nab, nms, 'update_postimage' FROM j
WHERE ok IS NOT NULL AND nk IS NOT NULL AND
      (on_ IS DISTINCT FROM nn OR onk IS DISTINCT FROM nnk OR oab IS DISTINCT FROM nab OR oms IS DISTINCT FROM nms)""")
def q_snapshot_diff(spark, d):
    old = V.table(spark, d, "customer")
    new = upsert(old, _updates(spark, d), ["c_custkey"]).filter(
        (F.col("c_custkey") % 25 != 0) | (F.col("c_custkey") % 10 == 0))
    return snapshot_diff(old, new, ["c_custkey"])


# Changes to the keys below this only: the other ranges are never read.
FEED_KEYS, FEED_SPAN = 400, 128


@register("change_feed", "SNK-11, JOIN-4", f"""WITH new_snap AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 10 = 0 AND c_custkey < {FEED_KEYS} THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE NOT (c_custkey % 25 = 7 AND c_custkey < {FEED_KEYS})
  UNION ALL SELECT c_custkey + {NEW_KEY_OFFSET}, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey <= 5)
SELECT *, 'update_preimage' AS _change_type FROM customer WHERE c_custkey % 10 = 0 AND c_custkey < {FEED_KEYS} AND c_custkey % 25 <> 7
UNION ALL SELECT n.*, 'update_postimage' FROM new_snap n WHERE c_custkey % 10 = 0 AND c_custkey < {FEED_KEYS}
UNION ALL SELECT *, 'delete' FROM customer WHERE c_custkey % 25 = 7 AND c_custkey < {FEED_KEYS}
UNION ALL SELECT n.*, 'insert' FROM new_snap n WHERE c_custkey >= {NEW_KEY_OFFSET}""")
def q_change_feed(spark, d):
    """Between two stored snapshots, by the digests of their key ranges."""
    old, new = scratch_path(spark, "snapshot-old"), scratch_path(spark, "snapshot-new")
    c = V.table(spark, d, "customer")
    few = F.col("c_custkey") < FEED_KEYS
    changed = (c.filter(~((F.col("c_custkey") % 25 == 7) & few))
               .withColumn("c_acctbal", F.when((F.col("c_custkey") % 10 == 0) & few, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
               .unionByName(c.filter(F.col("c_custkey") <= 5).withColumn("c_custkey", F.col("c_custkey") + NEW_KEY_OFFSET)))
    store_snapshot(c, old, ["c_custkey"], span=FEED_SPAN)
    store_snapshot(changed, new, ["c_custkey"], span=FEED_SPAN)
    return change_feed(spark, old, new, ["c_custkey"])


@register("evolve_append", "SNK-3, SRC-4, SRC-5, SNK-1", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_custkey % 2 = 1 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def q_evolve_append(spark, d):
    c = V.table(spark, d, "customer")
    path = scratch_path(spark, "evolve")
    first = c.filter(F.col("c_custkey") % 2 == 1).drop("c_mktsegment").withColumn("c_nationkey", F.col("c_nationkey").cast("smallint"))
    write_table(first, path, mode="overwrite")
    out = evolve_append(read_table(spark, path), c.filter(F.col("c_custkey") % 2 == 0))
    return out.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("merge_schema_write", "SNK-1, SRC-5, SRC-14", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment
FROM customer""")
def q_merge_schema_write(spark, d):
    """An append with a new column, stored and read by path."""
    c = V.table(spark, d, "customer")
    path = scratch_path(spark, "evolve-stored")
    write_table(c.filter(F.col("c_custkey") % 2 == 1).drop("c_mktsegment"), path)
    write_table(c.filter(F.col("c_custkey") % 2 == 0), path, mode="append", merge_schema=True)
    return read_table(spark, path).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("partition_overwrite", "SNK-2, SNK-4", V.with_views("orders_hdr") + """
, agg AS (
  SELECT CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month, status,
         count(*) AS n_orders, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
  FROM orders_hdr GROUP BY 1, 2, 3)
-- Dynamic overwrite replaces exactly the (year, month) slices present in the new batch.
, fresh AS (SELECT * FROM agg WHERE year = 2001 AND status = 'PROCESSING')
SELECT * FROM agg a WHERE a.status = 'COMPLETED'
  AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.year = a.year AND f.month = a.month)
UNION ALL SELECT * FROM fresh""")
def q_partition_overwrite(spark, d):
    from tierline.functions.money import as_int, money_sum
    o = V.orders_hdr(spark, d)
    monthly = (o.groupBy(as_int(F.year("order_date")).alias("year"),
                         as_int(F.month("order_date")).alias("month"), "status")
               .agg(F.count(F.lit(1)).alias("n_orders"), money_sum("total_amount").alias("revenue")))
    path = scratch_path(spark, "monthly")
    write_table(monthly.filter(F.col("status") == "COMPLETED"), path, partition_by=["year", "month"])
    # Replace only the 2001 slices, with another status's figures.
    write_table(monthly.filter((F.col("year") == 2001) & (F.col("status") == "PROCESSING")), path,
                partition_by=["year", "month"], dynamic_overwrite=True)
    back = read_source(spark, path, "parquet")
    return back.select(F.col("year").cast("int"), F.col("month").cast("int"), "status", "n_orders", "revenue")


@register("csv_roundtrip", "SNK-10, SRC-1, SRC-2, SRC-8, SRC-14, CLN-4", "SELECT * FROM customer")
def q_csv_roundtrip(spark, d):
    c = V.table(spark, d, "customer")
    path = scratch_path(spark, "csv")
    write_csv(c, path, quote_all=True)
    back = read_source(spark, path, "csv")                 # header + inferred types
    return enforce_schema(back, c.schema)


def _landing_lines(spark, d):
    """Order lines as CSV text: every 7th row has a non-numeric price,
    every 11th (not 7th) row is missing its price field."""
    o = V.table(spark, d, "orders")
    k = F.col("o_orderkey")
    base = F.concat_ws(",", k.cast("string"), F.col("o_custkey").cast("string"))
    line = (F.when(k % 7 == 0, F.concat(base, F.lit(",n/a")))
            .when(k % 11 == 0, base)
            .otherwise(F.concat(base, F.lit(","), F.col("o_totalprice").cast("string"))))
    return o.select(line.alias("value"), F.year("o_orderdate").alias("yr"))


LANDING_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_totalprice double"


def _write_landing(spark, d):
    root = scratch_path(spark, "landing")
    lines = _landing_lines(spark, d)
    lines.write.partitionBy("yr").text(root)
    # A file set the glob must skip: the same rows as JSON in the same tree.
    lines.write.mode("append").partitionBy("yr").json(root)
    return root


@register("landing_drop_malformed", "SRC-6, SRC-7", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS yr
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0""")
def q_landing_drop_malformed(spark, d):
    root = _write_landing(spark, d)
    df = read_landing(spark, root, glob="*.txt", schema=LANDING_SCHEMA, bad_rows="drop", header=False)
    return df.select("o_orderkey", "o_custkey", "o_totalprice", F.col("yr").cast("int"))


@register("quarantine_split", "SRC-7, SRC-6", """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ',n/a'
            ELSE CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) END AS _corrupt_record,
       o_orderkey, CAST(year(o_orderdate) AS INT) AS yr
FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""")
def q_quarantine_split(spark, d):
    root = _write_landing(spark, d)
    good, bad = read_landing(spark, root, glob="*.txt", schema=LANDING_SCHEMA,
                             bad_rows="quarantine", header=False)
    return bad.select("_corrupt_record", "o_orderkey", F.col("yr").cast("int"))


@register("bad_row_counts", "SRC-7", """
SELECT part, count(*) AS n, sum(k)::BIGINT AS keys FROM (
  SELECT CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'bad' ELSE 'good' END AS part, o_orderkey AS k FROM orders
  UNION ALL SELECT 'good, dropped', o_orderkey FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0)
GROUP BY part""")
def q_bad_row_counts(spark, d):
    """Both halves, each from a single column, and the counts."""
    root = _write_landing(spark, d)
    opts = {"glob": "*.txt", "schema": LANDING_SCHEMA, "header": False}
    good, bad = read_landing(spark, root, bad_rows="quarantine", **opts)
    dropped = read_landing(spark, root, bad_rows="drop", **opts)
    one = [df.select(F.lit(part).alias("part"), F.col("o_orderkey").alias("k"))
           for part, df in (("good", good), ("bad", bad), ("good, dropped", dropped))]
    return one[0].unionByName(one[1]).unionByName(one[2]).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys"))


AUDIT_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)


@register("audit_row", "SNK-12, VAL-1", f"""
SELECT 'run-0001' AS pipeline_run_id, 'bronze.orders' AS table_name, 'bronze' AS layer,
       'Succeeded' AS status, TIMESTAMP '2024-01-01 00:00:00' AS processed_at,
       count(*) AS records_processed FROM orders""")
def q_audit_row(spark, d):
    path = scratch_path(spark, "audited")
    stats = write_table(V.orders_hdr(spark, d), path)
    return audit_row(spark, "run-0001", "bronze.orders", "bronze", "Succeeded", stats["rows"], AUDIT_TS)


# --- layer jobs -------------------------------------------------------------

from tierline.plans.jobs import GOLD_TABLES, publish_silver, to_bronze, to_gold, to_silver  # noqa: E402

INGEST_TS_FIXED = "2024-01-01 00:00:00"


@register("bronze_job", "BRZ-1, SRC-1, SRC-6, SRC-10, SRC-11, PRJ-1, SNK-1, SNK-2, VAL-1, VAL-2", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
       o_totalprice AS total_amount, o_orderstatus AS status, CAST(year(o_orderdate) AS INT) AS yr
FROM orders""")
def q_bronze_job(spark, d):
    o = V.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("yr"))
    landing = scratch_path(spark, "landing-orders")
    o.write.partitionBy("yr").option("header", True).csv(landing)
    dest = scratch_path(spark, "bronze-orders")
    # First run: a full load of the older part (as if the rest had not landed yet).
    older = scratch_path(spark, "landing-older")
    o.filter(F.col("order_date") <= F.lit(TARGET_CUTOFF).cast("date")).write.partitionBy("yr") \
        .option("header", True).csv(older)
    to_bronze(spark, older, dest, mode="full", watermark_col="order_date", glob="*.csv",
              ingest_ts=INGEST_TS_FIXED, optimize=False)
    # Second run: incremental over the whole landing area.
    facts = to_bronze(spark, landing, dest, mode="incremental", watermark_col="order_date",
                      glob="*.csv", ingest_ts=INGEST_TS_FIXED, optimize=False)
    assert facts["new_rows"] == facts["rows_written"]
    return read_table(spark, dest).select("order_id", "customer_id", "order_date", "total_amount",
                                          "status", F.col("yr").cast("int"))


@register("incremental_overlap", "SRC-11, BRZ-1", """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total_amount, CAST(year(o_orderdate) AS INT) AS yr
FROM orders""")
def q_incremental_overlap(spark, d):
    """Late rows at the mark, and a load that is run twice."""
    o = V.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"), F.year("o_orderdate").alias("yr"))
    cut = o.filter(F.col("order_date") <= F.lit(TARGET_CUTOFF).cast("date")).agg(F.max("order_date")).first()[0]
    late = (F.col("order_date") == F.lit(cut)) & (F.col("order_id") % 2 == 1)
    landing, dest = scratch_path(spark, "landing-late"), scratch_path(spark, "bronze-late")
    load = dict(watermark_col="order_date", glob="*.csv", ingest_ts=INGEST_TS_FIXED, optimize=False)
    o.filter((F.col("order_date") <= F.lit(cut)) & ~late).write.option("header", True).csv(f"{landing}/a")
    to_bronze(spark, f"{landing}/a", dest, mode="full", **load)
    o.filter((F.col("order_date") > F.lit(cut)) | late).write.option("header", True).csv(f"{landing}/b")
    for _ in range(2):
        to_bronze(spark, landing, dest, overlap=True, recursiveFileLookup=True, **load)
    return read_table(spark, dest).select("order_id", "order_date", "total_amount", F.col("yr").cast("int"))


_BRONZE_ROWS = """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total_amount,
       CASE WHEN o_orderdate > TIMESTAMP '{cut}' THEN o_orderstatus END AS status, CAST(year(o_orderdate) AS INT) AS yr
FROM orders"""


def _bronze_twice(spark, d, **opts):
    """A first load without ``status``, and an incremental one that has it."""
    o = V.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("yr"))
    old = F.col("order_date") <= F.lit(TARGET_CUTOFF).cast("date")
    root, dest = scratch_path(spark, "landing-evolved"), scratch_path(spark, "bronze-evolved")
    for name, rows in (("a", o.filter(old).drop("status")), ("b", o.filter(~old))):
        rows.repartition(4).write.option("header", True).csv(f"{root}/{name}")
    load = dict(watermark_col="order_date", glob="*.csv", ingest_ts=INGEST_TS_FIXED, partition_by=["yr"], **opts)
    to_bronze(spark, f"{root}/a", dest, mode="full", **load)
    return to_bronze(spark, f"{root}/b", dest, mode="incremental", **load), dest


@register("bronze_evolved", "BRZ-1, SRC-5, SNK-1, SNK-3", _BRONZE_ROWS.format(cut=TARGET_CUTOFF))
def q_bronze_evolved(spark, d):
    _, dest = _bronze_twice(spark, d, optimize=False)
    return read_table(spark, dest).select("order_id", "order_date", "total_amount", "status", F.col("yr").cast("int"))


@register("bronze_optimized", "BRZ-1, SNK-6", _BRONZE_ROWS.format(cut=TARGET_CUTOFF))
def q_bronze_optimized(spark, d):
    facts, dest = _bronze_twice(spark, d, optimize=True, min_rows_to_optimize=10)
    if facts["files_after"] > facts["files_before"]:
        raise RuntimeError(f"compaction left {facts['files_after']} files of {facts['files_before']}")
    return read_table(spark, dest).select("order_id", "order_date", "total_amount", "status", F.col("yr").cast("int"))


SILVER_AS_OF = "1998-01-01"


@register("silver_job", "SLV-1, CLN-1, CLN-6, DQ-4, DQ-5, PRJ-2, SNK-7", f"""
SELECT l_orderkey, l_linenumber, l_partkey, trim(l_returnflag) AS l_returnflag, ship_date,
       _ingest_timestamp,
       CASE WHEN ship_date > DATE '{SILVER_AS_OF}' THEN 'ship_date:future_date' ELSE '' END
         AS _data_quality_issues,
       TIMESTAMP '{INGEST_TS_FIXED}' AS _silver_processed_timestamp
FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, ' ' || l_returnflag AS l_returnflag,
         CAST(l_shipdate AS DATE) AS ship_date, l_shipdate AS _ingest_timestamp,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate DESC, l_partkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_silver_job(spark, d):
    li = V.table(spark, d, "lineitem")
    bronze = li.select("l_orderkey", "l_linenumber", "l_partkey",
                       F.concat(F.lit(" "), "l_returnflag").alias("l_returnflag"),
                       F.to_date("l_shipdate").alias("ship_date"),
                       F.col("l_shipdate").alias("_ingest_timestamp"))
    keys = ["l_orderkey", "l_linenumber"]
    out = to_silver(bronze, keys=keys, ties=["l_partkey"], as_of=SILVER_AS_OF,
                    processed_ts=INGEST_TS_FIXED)
    path = scratch_path(spark, "silver")
    publish_silver(out, path, keys)
    return read_table(spark, path).withColumn(
        "_silver_processed_timestamp", F.col("_silver_processed_timestamp").cast("timestamp_ntz"))


@register("gold_job", "GLD-1..6, SNK-2, SNK-7, VAL-1", V.with_views("sales", "orders_hdr", "products") + """
SELECT 'daily_sales_summary' AS "table", count(DISTINCT CAST(order_date AS DATE)) AS row_count
  FROM orders_hdr WHERE status = 'COMPLETED'
UNION ALL SELECT 'product_performance', count(DISTINCT product_id) FROM sales WHERE status = 'COMPLETED'
UNION ALL SELECT 'category_performance', count(*) FROM (
  SELECT DISTINCT p.category, year(s.order_date), month(s.order_date)
  FROM sales s LEFT JOIN products p ON s.product_id = p.product_id WHERE s.status = 'COMPLETED')
UNION ALL SELECT 'customer_purchase_patterns', count(DISTINCT customer_id) FROM sales
UNION ALL SELECT 'dim_product', count(*) FROM products""")
def q_gold_job(spark, d):
    from tierline.plans.q_products import AS_OF
    root = scratch_path(spark, "gold")
    to_gold(V.sales(spark, d), V.products(spark, d), root, as_of=AS_OF,
            orders_hdr=V.orders_hdr(spark, d))
    return I.table_counts({t: read_table(spark, f"{root}/{t}") for t in GOLD_TABLES})


@register("json_roundtrip", "SRC-3, SRC-1, CLN-4", "SELECT * FROM events")
def q_json_roundtrip(spark, d):
    ev = V.table(spark, d, "events")
    path = scratch_path(spark, "json")
    # Microsecond timestamps (the writer's default pattern stops at millis).
    ev.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    # Spark writes JSON lines, so multiLine is turned off for this read; every
    # leaf arrives as text (primitivesAsString) and the schema restores types.
    back = read_source(spark, path, "json", multiLine=False)
    assert all(t == "string" for _, t in back.dtypes)
    return enforce_schema(back, ev.schema)


# Every stored gold table against the SQL of its product.
_GOLD_PRODUCT = {"daily_sales_summary": "daily_sales", "product_performance": "product_performance",
                 "category_performance": "category_performance", "customer_purchase_patterns": "customer_segments",
                 "dim_product": "dim_product"}


def _gold(spark, d, name, runs, mode):
    from tierline.plans.q_products import AS_OF, SEG_FREQ, SEG_RECENCY, SEG_SPEND
    root = scratch_path(spark, "gold-values")
    segments = {"spend": SEG_SPEND, "freq": SEG_FREQ, "recency": SEG_RECENCY}
    for keep in runs:
        to_gold(V.sales(spark, d), V.products(spark, d), root, as_of=AS_OF, orders_hdr=V.orders_hdr(spark, d).filter(keep),
                segments=segments, mode=mode, only=[name])
    return read_table(spark, f"{root}/{name}")


def register_gold(oracles: dict) -> None:
    for name, product in _GOLD_PRODUCT.items():
        def run(spark, d, name=name, product=product):
            from tierline.plans.registry import all_queries
            out = _gold(spark, d, name, [F.lit(True)], "overwrite")
            want = all_queries()[product].run(spark, d).schema
            return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want.fields])
        register(f"gold_{name}", "GLD-1..6, SNK-2, SNK-7", oracles[product])(run)

    @register("gold_replace_keys", "GLD-1, SNK-5", oracles["daily_sales"])
    def q_gold_replace_keys(spark, d):
        """Two upserts of whole days, some of them in both: every day once, none lost."""
        day = F.col("order_date")
        runs = [day < F.lit("2000-09-01").cast("timestamp_ntz"), day >= F.lit("1998-03-01").cast("timestamp_ntz")]
        return _gold(spark, d, "daily_sales_summary", runs, "replace_keys")

    # Three loads, each with some rows of every day, product and customer; the
    # first two are folded, and the second is run twice.
    merged = {"gold_merge": "daily_sales_summary", "gold_merge_products": "product_performance",
              "gold_merge_categories": "category_performance", "gold_merge_customers": "customer_purchase_patterns"}
    for query, name in merged.items():
        def run(spark, d, name=name):
            from tierline.plans.registry import all_queries
            out = _gold_increments(spark, d, name)
            want = all_queries()[_GOLD_PRODUCT[name]].run(spark, d).schema
            return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want.fields])
        register(query, "GLD-1..5, AGG-8, SNK-5", oracles[_GOLD_PRODUCT[name]])(run)


def _gold_increments(spark, d, name):
    from tierline.plans.q_products import AS_OF, SEG_FREQ, SEG_RECENCY, SEG_SPEND
    root = scratch_path(spark, "gold-increments")
    segments = {"spend": SEG_SPEND, "freq": SEG_FREQ, "recency": SEG_RECENCY}
    for load, third, fold in (("a", 0, False), ("b", 1, False), ("b", 1, True), ("c", 2, False)):
        mine = F.pmod(F.xxhash64("order_id"), F.lit(3)) == third
        to_gold(V.sales(spark, d).filter(mine), V.products(spark, d), root, as_of=AS_OF, orders_hdr=V.orders_hdr(spark, d).filter(mine),
                segments=segments, mode="merge", only=[name], load_id=load, fold=fold, cluster=False)
    return read_table(spark, f"{root}/{name}")


@register("snapshot_diff_added", "SNK-11", """
SELECT c_custkey, c_acctbal, NULL AS c_mktsegment, 'update_preimage' AS _change_type FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, 'update_postimage' FROM customer WHERE c_custkey % 3 = 0""")
def q_snapshot_diff_added(spark, d):
    """A column that only the new snapshot has, filled in every third row."""
    c = V.table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    new = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")))
    return snapshot_diff(c.drop("c_mktsegment"), new, ["c_custkey"])


@register("upsert_repeats", "SNK-5, CLN-6", """
SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 0 END AS c_acctbal,
       CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 0 END AS seq FROM customer""")
def q_upsert_repeats(spark, d):
    """An update batch with two rows per key: the later one wins."""
    c = V.table(spark, d, "customer").select("c_custkey", "c_acctbal", F.lit(0).alias("seq"))
    some = c.filter(F.col("c_custkey") % 4 == 0)
    updates = some.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("c_acctbal", F.col("c_acctbal") + F.col("seq"))
    return upsert(c, updates, ["c_custkey"], latest_by=["seq"])
