"""Stream dedup with a hot key, run facts of streams, file ranges, bloom
filters that skip, runtime filters and sketches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tierline.operators import quality as Q
from tierline.operators.layout import file_ranges, overlap_depth
from tierline.sinks.writers import write_table
from tierline.sources.readers import read_table
from tierline.streaming import pipelines as S
from tierline.streaming.audit import AuditListener, observed_rows

T = dt.datetime(2024, 1, 1)
EVENT = "k string, ts timestamp_ntz, v int"


def run_stream(df, tmp, name, **opts):
    w = df.writeStream.format("parquet").queryName(name).option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True)
    q = w.start(f"{tmp}/out")
    q.awaitTermination()
    return q


@pytest.mark.parametrize("rocksdb", [False, True])
def test_a_hot_key_reaches_its_state_task_as_one_row_per_task(spark, tmp_dir, rocksdb):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.34 else f"k{rng.randint(0, 60)}", T + dt.timedelta(seconds=i % 500), i) for i in range(6000)]
    rows += [(None, T, -1), (None, T + dt.timedelta(seconds=1), -2), ("null time", None, -3)]
    spark.createDataFrame(rows, EVENT).repartition(4).write.parquet(f"{tmp_dir}/in")
    keep = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    if rocksdb:
        S.use_rocksdb_state(spark)
    try:
        src = S.event_time(S.read_stream(spark, f"{tmp_dir}/in", EVENT), "ts")
        reduced = observed_rows(S.latest_per_task(src, ["k"], "ts"))
        q = run_stream(reduced.withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["k"]), tmp_dir, f"hot{rocksdb}")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", keep)
    first = next(p for p in q.recentProgress if p["numInputRows"])
    keys = {r[0] for r in rows}
    tasks = 4
    assert first["observedMetrics"]["tierline_rows"]["rows"] <= tasks * len(keys)
    got = spark.read.parquet(f"{tmp_dir}/out").collect()
    have = {(k, v): t for k, t, v in rows}
    assert sorted(str(r["k"]) for r in got) == sorted(map(str, keys))
    assert all((r["k"], r["v"]) in have for r in got)                    # whole rows of the input
    assert next(r for r in got if r["k"] == "hot")["v"] % 500 > 480      # of the hot key's latest


def test_latest_per_task_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, *[T + dt.timedelta(hours=h) for h in range(9)]]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, EVENT).withColumn("__key", F.lit("x")).coalesce(1)
    best = {}
    for k, t, v in rows:
        if k not in best or (t is not None and (best[k][1] is None or t > best[k][1])):
            best[k] = (k, t, v)
    got = [(r["k"], r["ts"], r["v"]) for r in S.latest_per_task(df, ["k"], "ts").collect()]
    assert sorted(got, key=str) == sorted(best.values(), key=str)
    assert S.latest_per_task(df.limit(0), ["k"], "ts").count() == 0


def test_streams_leave_audit_rows_with_late_rows(spark, tmp_dir):
    batches = [[("a", T, 1), ("b", T + dt.timedelta(hours=9), 2)],
               [("c", T + dt.timedelta(hours=1), 3), ("d", T + dt.timedelta(hours=8, minutes=30), 4), ("e", T + dt.timedelta(hours=10), 5)]]
    with AuditListener(spark, f"{tmp_dir}/audit", {"audited": ("bronze.t", "bronze")}, flush=1):
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(f"{tmp_dir}/in/{i}")
            src = observed_rows(S.read_stream(spark, f"{tmp_dir}/in/*", EVENT))
            run_stream(S.stream_dedup(src, ["k"], "ts", "1 hour"), tmp_dir, "audited")
        run_stream(S.read_stream(spark, f"{tmp_dir}/in/0", EVENT), f"{tmp_dir}/other", "not audited")
    audit = sorted(read_table(spark, f"{tmp_dir}/audit").collect(), key=lambda r: r["batch_id"])
    assert [(r["rows_read"], r["rows_observed"], r["rows_late"], r["status"], r["table_name"]) for r in audit] == [
        (2, 2, 0, "Succeeded", "bronze.t"), (3, 3, 1, "Succeeded", "bronze.t")]
    bad = spark.createDataFrame(batches[0], EVENT)
    bad.write.parquet(f"{tmp_dir}/in2")
    with AuditListener(spark, f"{tmp_dir}/audit2", {"failing": ("bronze.t", "bronze")}):
        src = S.read_stream(spark, f"{tmp_dir}/in2", EVENT).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
        with pytest.raises(Exception, match="broken"):
            run_stream(src, f"{tmp_dir}/x", "failing")
    assert [r["status"] for r in read_table(spark, f"{tmp_dir}/audit2").collect()] == ["Failed"]


def test_overlap_depth_against_brute_force(spark):
    rng = random.Random(2)
    ranges = [(f"f{i}", c, *sorted((float(rng.randint(0, 30)), float(rng.randint(0, 30))))) for i in range(40) for c in ("a", "b")]
    got = {r["column"]: r for r in overlap_depth(spark.createDataFrame(ranges, "file string, column string, lo double, hi double")).collect()}
    for c in ("a", "b"):
        mine = [(lo, hi) for _, k, lo, hi in ranges if k == c]
        counts = [sum(x <= hi and y >= lo for x, y in mine) for lo, hi in mine]
        most = max(sum(x <= p <= y for x, y in mine) for p in {v for r in mine for v in r})
        assert got[c]["files"] == 40 and got[c]["max_depth"] == most and abs(got[c]["mean_depth"] - sum(counts) / 40) < 1e-9


def test_file_ranges(spark, tmp_dir):
    df = spark.range(90).selectExpr("cast(if(id < 30, null, id) as int) a", "date_add(date'2024-01-01', cast(id as int)) d")
    df.repartitionByRange(3, "d").write.parquet(f"{tmp_dir}/t")
    got = file_ranges(read_table(spark, f"{tmp_dir}/t"), ["a", "d"]).collect()
    assert sorted(r["lo"] for r in got if r["column"] == "d")[0] == 19723.0 and len([r for r in got if r["column"] == "d"]) == 3
    assert min(r["lo"] for r in got if r["column"] == "a") == 30.0


def rows_scanned(df):
    """Rows that the file scan of ``df`` handed on, from its metrics."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_written_bloom_filters_skip_row_groups(spark, tmp_dir):
    df = spark.range(400_000).selectExpr("id * 2 as k", "cast(id % 7 as int) v").repartition(2, "v")
    absent = F.col("k") == 300_001                        # inside every file's least and greatest value
    for name, cols in (("plain", []), ("bloom", ["k"])):
        write_table(df, f"{tmp_dir}/{name}", bloom_cols=cols)
    assert rows_scanned(read_table(spark, f"{tmp_dir}/plain").filter(absent)) > 0
    assert rows_scanned(read_table(spark, f"{tmp_dir}/bloom").filter(absent)) == 0
    assert read_table(spark, f"{tmp_dir}/bloom").filter(F.col("k") == 300_002).count() == 1


def test_large_joins_get_a_runtime_bloom_filter(spark, tmp_dir):
    from tierline.session import runtime_filters
    spark.range(200_000).selectExpr("id as k", "id % 11 as v").write.parquet(f"{tmp_dir}/fact")
    spark.range(2000).selectExpr("id as k", "id % 500 as c").write.parquet(f"{tmp_dir}/dim")
    fact, dim = read_table(spark, f"{tmp_dir}/fact"), read_table(spark, f"{tmp_dir}/dim")
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.optimizer.runtime.bloomFilter.enabled",
             "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"]
    keep = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "-1")
        runtime_filters(spark, min_scan_bytes=0)
        j = fact.join(dim.filter("c = 7"), "k")
        assert "might_contain" in j._jdf.queryExecution().optimizedPlan().toString()
        assert j.count() == 4
    finally:
        for n, v in keep.items():
            spark.conf.set(n, v)


def test_sketches_add_up(spark):
    rng = random.Random(1)
    rows = [(i % 5, rng.choice([None, float("nan"), rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(5, 2)]), 1.0) for i in range(20000)]
    df = spark.createDataFrame(rows, "p int, x double, one double")
    per = Q.profile_sketches(df, ["x", "one"], by=["p"], k=200)
    assert per.count() == 5
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    merged = Q.sketch_profile(Q.merge_sketches(per, ["x", "one"]), ["x", "one"], probs).collect()
    got = {r["column"]: r for r in merged}
    values = sorted(v for _, v, _ in rows if v is not None and v == v)
    assert got["x"]["count"] == len(values) and got["one"]["q2"] == 1.0
    for i, p in enumerate(probs):
        rank = sum(v <= got["x"][f"q{i}"] for v in values) / len(values)
        assert abs(rank - p) <= Q.kll_rank_bound(200)
    none = Q.profile_sketches(df.filter("x is null"), ["x"])
    assert [(r["count"], r["q0"]) for r in Q.sketch_profile(none, ["x"]).collect()] == [(0, None)]
