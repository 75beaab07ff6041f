"""Footers, overlap loads, change feeds between stored snapshots, folded streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tierline.operators.changefeed import change_feed, changed_ranges, store_snapshot
from tierline.operators.merge import snapshot_diff
from tierline.sinks.writers import write_table
from tierline.sources import incremental as I
from tierline.sources.footers import footer_aggregates, pushed_aggregates
from tierline.sources.readers import read_table
from tierline.streaming import pipelines as S


def texts(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().toString()


# -- footers --------------------------------------------------------------------

FACTS = {"n": ("count", None), "lo": ("min", "k"), "hi": ("max", "d")}


def test_footers_answer_counts_and_extremes(spark, tmp_dir):
    df = spark.range(1000).selectExpr("id as k", "date_add(date'2024-01-01', cast(id % 90 as int)) as d", "cast(id % 3 as int) as p", "cast(id as string) as s")
    for parts in ([], ["p"]):
        path = f"{tmp_dir}/{len(parts)}"
        write_table(df.repartition(4), path, partition_by=parts)
        table = read_table(spark, path)
        assert "PushedAggregation: [COUNT(*), MIN(k), MAX(d)]" in plan(pushed_aggregates(table, FACTS))
        assert footer_aggregates(table, FACTS) == {"n": 1000, "lo": 0, "hi": dt.date(2024, 3, 30)}
        assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    # no exact statistics: strings, and partition columns, which are in no file
    for c in ("s", "p"):
        assert pushed_aggregates(table, {"m": ("max", c)}) is None
    assert footer_aggregates(table, {"m": ("max", "s")}) == {"m": "999"} and footer_aggregates(table, {"m": ("max", "p")}) == {"m": 2}


def test_footers_fall_back_where_a_file_has_no_statistics(spark, tmp_dir):
    kind = "k bigint, x double"
    for i, rows in enumerate([[(1, 2.0)], [(2, None)], [(3, float("nan"))]]):
        path = f"{tmp_dir}/{i}"
        write_table(spark.createDataFrame([(0, 1.0)], kind).coalesce(1), path)
        write_table(spark.createDataFrame(rows, kind).coalesce(1), path, mode="append")
        got = footer_aggregates(read_table(spark, path), {"hi": ("max", "x"), "n": ("count", None)})
        assert got["n"] == 2 and (str(got["hi"]) == ["2.0", "1.0", "nan"][i])
    write_table(spark.createDataFrame([], kind), f"{tmp_dir}/none")
    assert footer_aggregates(read_table(spark, f"{tmp_dir}/none"), {"n": ("count", None), "hi": ("max", "k")}) == {"n": 0, "hi": None}
    # a projection: Spark would take another column's statistics
    two = read_table(spark, f"{tmp_dir}/0").select("x", "k")
    assert pushed_aggregates(two, {"hi": ("max", "k")}) is None and footer_aggregates(two, {"hi": ("max", "k")}) == {"hi": 1}
    assert pushed_aggregates(two.select("x"), {"n": ("count", None)}) is None
    # a column that older files do not have
    write_table(spark.createDataFrame([(1,)], "k bigint"), f"{tmp_dir}/old")
    write_table(spark.createDataFrame([(2, 5.0)], kind), f"{tmp_dir}/old", mode="append", merge_schema=True)
    assert footer_aggregates(read_table(spark, f"{tmp_dir}/old"), {"hi": ("max", "x")}) == {"hi": 5.0}


# -- overlap loads -----------------------------------------------------------------

def test_rows_that_share_the_watermark_are_neither_lost_nor_doubled(spark):
    kind = "k int, wm int, note string"
    have = spark.createDataFrame([(1, 1, "a"), (2, 5, None), (3, 5, "c"), (3, 5, "c")], kind).withColumn("_ts", F.current_timestamp())
    source = spark.createDataFrame([(0, 4, "late, below"), (2, 5, None), (3, 5, "c"), (3, 5, "d"), (4, 5, None), (5, 6, "new"), (6, None, "none")], kind)
    got = I.overlap_load(source, have, "wm", 5)
    assert texts(got) == texts(spark.createDataFrame([(3, 5, "d"), (4, 5, None), (5, 6, "new")], kind))
    after = have.drop("_ts").unionByName(got)
    assert I.overlap_load(source, after, "wm", 6).count() == 0
    assert I.overlap_load(source, have, "wm", None).count() == 7
    # text as read from a file, and a column that the target has not got
    typed = source.withColumn("k", F.col("k").cast("string")).withColumn("extra", F.when(F.col("k") == 2, F.lit("x")))
    got = I.overlap_load(typed, have, "wm", 5)
    assert sorted((r["k"], r["note"], r["extra"]) for r in got.collect() if r["wm"] == 5) == [(2, None, "x"), (3, "d", None), (4, None, None)]


# -- change feed ----------------------------------------------------------------------

def feed_rows(spark, n, seed, changes):
    rng = random.Random(seed)
    base = {k: (k, rng.choice([None, "a", "b"]), rng.choice([None, 0.5]), [k % 3]) for k in range(-20, n)}
    for k in changes:
        if k in base and rng.random() < 0.3:
            del base[k]
        else:
            base[k] = (k, None, 0.25, None)
    rows = [*base.values(), (None, "null key", None, None), base[5], base[5]]
    return spark.createDataFrame(rows, "k bigint, v string, x double, l array<int>")


@pytest.mark.parametrize(("span", "buckets"), [(16, 4), (1000, 1)])
def test_feed_equals_the_full_diff_and_reads_changed_ranges_only(spark, tmp_dir, span, buckets):
    old, new = feed_rows(spark, 300, 1, []), feed_rows(spark, 300, 1, [40, 41, 45, 200, 205, 500])
    for name, df in (("old", old), ("new", new)):
        store_snapshot(df, f"{tmp_dir}/{name}", ["k"], span, buckets)
    got = change_feed(spark, f"{tmp_dir}/old", f"{tmp_dir}/new", ["k"])
    assert texts(got) == texts(snapshot_diff(old, new, ["k"])) and got.count() > 5
    if span == 16:
        assert changed_ranges(spark, f"{tmp_dir}/old", f"{tmp_dir}/new") == [2, 12, 31]
        scans = [x for x in plan(got).split("== Physical Plan ==")[1].split("\n") if "FileScan" in x]
        assert scans and all("PartitionFilters: [_range" in x for x in scans)
    assert change_feed(spark, f"{tmp_dir}/old", f"{tmp_dir}/old", ["k"]).count() == 0


def test_feed_of_other_keys_and_a_new_column(spark, tmp_dir):
    old = spark.createDataFrame([("a", 1), ("b", None), (None, 3)], "k string, v int")
    new = spark.createDataFrame([("a", 1, "x"), ("c", None, None), (None, 3, None)], "k string, v int, w string")
    for name, df in (("old", old), ("new", new)):
        store_snapshot(df, f"{tmp_dir}/{name}", ["k"], buckets=8)
    assert texts(change_feed(spark, f"{tmp_dir}/old", f"{tmp_dir}/new", ["k"])) == texts(snapshot_diff(old, new, ["k"]))
    # a null in one column is no null in another
    a, b = (spark.createDataFrame([("k", *v)], "k string, p int, q int") for v in ((None, 5), (5, None)))
    store_snapshot(a, f"{tmp_dir}/a", ["k"])
    store_snapshot(b, f"{tmp_dir}/b", ["k"])
    assert change_feed(spark, f"{tmp_dir}/a", f"{tmp_dir}/b", ["k"]).count() == 2


# -- folded change tables ---------------------------------------------------------------

KIND = "k int, v string, seq int"


def brute_state(batches):
    best = {}
    for epoch, rows in enumerate(batches):
        for k, v, seq in rows:
            rank = (seq is not None, seq or 0, epoch, v is not None, v or "")
            if k not in best or rank >= best[k][0]:
                best[k] = (rank, (k, v, seq))
    return sorted((r for _, r in best.values()), key=str)


def test_folds_between_batches_change_no_result(spark, tmp_dir):
    rng, dest, base = random.Random(4), f"{tmp_dir}/changes", "tl_fold_base"
    spark.sql(f"DROP TABLE IF EXISTS {base}")
    batches = []
    for epoch in range(7):
        hot = [(1, f"hot{i}", rng.choice([None, epoch])) for i in range(20)]
        batches.append(hot + [(rng.choice([None, *range(40)]), rng.choice([None, "a", "b", "c"]), rng.choice([None, rng.randint(0, 6)])) for _ in range(40)])
        S.append_changes(spark.createDataFrame(batches[-1], KIND), dest, "s", epoch)
        if epoch in (2, 5):
            assert S.fold_changes(spark, dest, base, ["k"], ["seq"], buckets=4) == (2 if epoch == 2 else 3)
        got = S.current_state(spark, dest, ["k"], ["seq"], base=base)
        assert sorted((tuple(r) for r in got.select("k", "v", "seq").collect()), key=str) == brute_state(batches)
    assert sorted(r[0] for r in S.read_changes(spark, dest).select(S.EPOCH_COL).distinct().collect()) == [5, 6]
    # a fold that is cut short before the epochs are deleted
    keep = S.drop_directory
    S.drop_directory = lambda *a: None
    try:
        S.fold_changes(spark, dest, base, ["k"], ["seq"], buckets=4, settled=0)
    finally:
        S.drop_directory = keep
    got = S.current_state(spark, dest, ["k"], ["seq"], base=base)
    assert sorted((tuple(r) for r in got.select("k", "v", "seq").collect()), key=str) == brute_state(batches)
    # the base is joined on its buckets: only the changes are shuffled
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        got = S.current_state(spark, dest, ["k"], ["seq"], base=base)
        got.collect()
        text = plan(got).split("== Physical Plan ==")[1]
        scan = next(x for x in text.split("\n") if "FileScan" in x and "Bucketed: true" in x)
        depth = scan.index("FileScan")
        above = [x for x in text.split(scan)[0].split("\n") if "Exchange" in x]
        assert "SortMergeJoin" in text and all("_key" not in x or x.index("Exchange") >= depth or "new" in x for x in above)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # everything folded, then a batch with a new column
    S.fold_changes(spark, dest, base, ["k"], ["seq"], buckets=4, settled=0)
    assert S.read_changes(spark, dest) is None
    S.append_changes(spark.createDataFrame([(1, "last", 99, "n")], KIND + ", w string"), dest, "s", 9)
    got = {r["k"]: r for r in S.current_state(spark, dest, ["k"], ["seq"], base=base).collect()}
    assert got[1]["w"] == "n" and len(got) == len(brute_state(batches)) and got[2]["w"] is None
    spark.sql(f"DROP TABLE IF EXISTS {base}")
