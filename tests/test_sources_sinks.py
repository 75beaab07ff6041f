"""Readers, writers and table options on built files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tierline.operators.layout import compact, table_detail
from tierline.operators.preview import preview
from tierline.session import PROFILES, apply_profile, size_shuffle
from tierline.sinks.writers import evolve_append, write_csv, write_table
from tierline.sources.readers import read_landing, read_options, read_source

from conftest import SF_SMALL


def test_read_options_merge_order():
    assert read_options("csv")["header"] == "true"
    assert read_options("json")["primitivesAsString"] == "true"
    assert read_options("orc") == {"mergeSchema": "true"}
    assert read_options("csv", header=False)["header"] == "false"


def test_json_multiline_primitives_as_string(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.json"), "w") as fh:
        json.dump([{"id": 1, "price": 9.5, "tags": ["x"], "nested": {"k": 2}},
                   {"id": 2, "price": None, "tags": [], "nested": {"k": 3}}], fh, indent=2)
    df = read_source(spark, tmp_dir, "json")
    types = dict(df.dtypes)
    assert types["id"] == "string" and types["price"] == "string"
    assert types["nested"] == "struct<k:string>" and types["tags"] == "array<string>"
    assert sorted(r["id"] for r in df.collect()) == ["1", "2"]


def test_csv_quarantine_counts(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "orders1.csv"), "w") as fh:
        fh.write("id,qty\n1,5\n2,abc\n3\n")
    schema = "id int, qty int"
    kept = read_landing(spark, tmp_dir, glob="orders*.csv", schema=schema, bad_rows="drop")
    assert [tuple(r) for r in kept.collect()] == [(1, 5)]
    good, bad = read_landing(spark, tmp_dir, glob="orders*.csv", schema=schema, bad_rows="quarantine")
    assert good.count() == 1 and bad.count() == 2
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["2,abc", "3"]


def test_landing_glob_and_partition_discovery(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "dt=2024-01-01"))
    with open(os.path.join(tmp_dir, "dt=2024-01-01", "orders1.csv"), "w") as fh:
        fh.write("id\n1\n2\n")
    with open(os.path.join(tmp_dir, "dt=2024-01-01", "other.csv"), "w") as fh:
        fh.write("id\n99\n")
    df = read_landing(spark, tmp_dir, glob="orders*.csv")
    assert sorted(r["id"] for r in df.collect()) == [1, 2]
    assert "dt" in df.columns


def test_csv_sink_quotes_everything(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a,b")], "id int, txt string")
    write_csv(df, tmp_dir + "/out")
    text = "".join(open(os.path.join(tmp_dir, "out", f)).read()
                   for f in os.listdir(tmp_dir + "/out") if f.endswith(".csv"))
    assert '"id","txt"' in text and '"1","a,b"' in text


def test_evolve_append_widens_and_fills(spark):
    old = spark.createDataFrame([(1, "x")], "id bigint, a string")
    new = spark.createDataFrame([(2, 5)], "id int, b int")
    out = evolve_append(old, new)
    assert out.columns == ["id", "a", "b"] and dict(out.dtypes)["id"] == "bigint"
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "x", None), (2, None, 5)], key=repr)


def test_evolve_append_never_destroys_values(spark):
    import pytest
    small = spark.createDataFrame([(1, 1.5)], "a int, b float")
    out = evolve_append(small, spark.createDataFrame([(3_000_000_000, 2.25)], "a bigint, b double"))
    assert sorted(map(tuple, out.collect())) == [(1, 1.5), (3_000_000_000, 2.25)]
    with pytest.raises(TypeError):
        evolve_append(small, spark.createDataFrame([("x", 1.0)], "a string, b float"))


def test_append_to_a_catalog_table_with_a_new_column(spark):
    import pytest
    spark.sql("DROP TABLE IF EXISTS tl_evolving")
    try:
        write_table(spark.createDataFrame([(1, "a")], "k int, v string"), "tl_evolving", as_table=True)
        more = spark.createDataFrame([(2, 5, "b")], "k int, w int, v string")
        with pytest.raises(TypeError, match="merge_schema"):
            write_table(more, "tl_evolving", mode="append", as_table=True)
        write_table(more, "tl_evolving", mode="append", as_table=True, merge_schema=True)
        rows = spark.table("tl_evolving").select("k", "v", "w").collect()
        assert sorted(map(tuple, rows)) == [(1, "a", None), (2, "b", 5)]
        with pytest.raises(TypeError, match="does not fit"):
            write_table(spark.createDataFrame([(1 << 40, "c")], "k bigint, v string"), "tl_evolving", mode="append", as_table=True)
    finally:
        spark.sql("DROP TABLE IF EXISTS tl_evolving")


def test_bad_rows_do_not_depend_on_the_projection(spark, tmp_dir):
    from tierline.sources.readers import read_landing
    with open(tmp_dir + "/rows.csv", "w") as fh:
        fh.write("a,b,c\n1,2,3\n4,5\n6,x,7\n8,9,ten\n")
    kind = "a int, b int, c int"
    good = read_landing(spark, tmp_dir, glob="*.csv", schema=kind, bad_rows="drop")
    assert good.count() == len(good.collect()) == good.select("a").count() == 1
    good, bad = read_landing(spark, tmp_dir, glob="*.csv", schema=kind, bad_rows="quarantine")
    assert (good.select("b").count(), bad.select("a").count(), bad.count()) == (1, 3, 3)
    assert sorted(r["_corrupt_record"] for r in bad.select("_corrupt_record").collect()) == ["4,5", "6,x,7", "8,9,ten"]


def test_upsert_refuses_repeated_keys_and_keeps_new_columns(spark):
    import pytest
    from tierline.operators.merge import upsert
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(Exception, match="repeated key"):
        upsert(old, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"]).collect()
    out = upsert(old, spark.createDataFrame([(2, "B", 7)], "k int, v string, n int"), ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, "a", None), (2, "B", 7)]


def test_money_is_the_decimal_sum_and_nan_is_missing(spark):
    from tierline.functions.money import exact_mean, exact_sum, mean_of_money, money_sum
    df = spark.createDataFrame([(0.285,), (1.005,), (float("nan"),), (None,), (float("inf"),)], "x double")
    r = df.agg(money_sum("x").alias("s"), mean_of_money("x").alias("m")).first()
    assert (r["s"], r["m"]) == (1.30, 0.65)
    fine = spark.range(1000).selectExpr("0.004D as x")
    r = fine.agg(exact_sum("x").alias("s"), exact_mean("x").alias("m"), money_sum("x").alias("c")).first()
    assert (r["s"], r["m"], r["c"]) == (4.0, 0.004, 0.0)


def test_profile_quantiles_are_exact_and_skip_nan(spark):
    import math
    from tierline.operators.quality import profile
    values = [float(i * 37 % 1009) for i in range(1009)] + [5.0] * 400
    df = spark.createDataFrame([(x,) for x in values] + [(float("nan"),), (None,)], "x double").repartition(5)
    r = profile(df, ["x"]).first()
    values.sort()
    want = [values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75)]
    assert [r["p25"], r["p50"], r["p75"]] == want and r["count"] == len(values) and r["max"] == 1008.0
    empty = profile(df.limit(0), ["x"]).first()
    assert empty["count"] == 0 and empty["p50"] is None


def test_bucketed_tables_join_without_shuffle(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    write_table(o, "tl_orders_b", mode="overwrite", bucket_by=(8, ["o_orderkey"]))
    write_table(li, "tl_lineitem_b", mode="overwrite", bucket_by=(8, ["l_orderkey"]))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("tl_lineitem_b").join(spark.table("tl_orders_b"),
                                              F.col("l_orderkey") == F.col("o_orderkey"))
        j.write.format("noop").mode("overwrite").save()
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.sql("DROP TABLE IF EXISTS tl_orders_b")
        spark.sql("DROP TABLE IF EXISTS tl_lineitem_b")


def test_compaction_reduces_files(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    write_table(li.repartition(16), tmp_dir + "/small")
    small = spark.read.parquet(tmp_dir + "/small")
    assert table_detail(small).first()["num_files"] == 16
    write_table(compact(small, target_file_mb=1), tmp_dir + "/big")
    big = spark.read.parquet(tmp_dir + "/big")
    d = table_detail(big).first()
    assert d["num_files"] == 1 and d["num_rows"] == li.count()


def test_write_counts_rows_and_bloom_option(spark, tmp_dir):
    df = spark.range(1000).withColumnRenamed("id", "k")
    stats = write_table(df, tmp_dir + "/b", bloom_cols=["k"], max_records_per_file=300)
    assert stats == {"rows": 1000}
    assert table_detail(spark.read.parquet(tmp_dir + "/b")).first()["num_files"] >= 4


def test_preview_is_ordered(spark):
    df = spark.range(100)
    assert [r["id"] for r in preview(df, 3, [F.desc("id")]).collect()] == [99, 98, 97]


def test_profiles_and_shuffle_sizing(spark):
    keys = set(PROFILES["dev"]) | {"spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                   "spark.sql.adaptive.advisoryPartitionSizeInBytes"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        apply_profile(spark, "dev")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
        assert "spark.sql.autoBroadcastJoinThreshold" in PROFILES["prod"]
        assert size_shuffle(spark, 100 * 1024 ** 4) == 819200
        assert size_shuffle(spark, 10) == 200
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_upsert_latest_by_collapses_duplicate_updates(spark):
    from tierline.operators.merge import upsert
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, ts int")
    u = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1)], "k int, v string, ts int")
    got = sorted(map(tuple, upsert(t, u, ["k"], latest_by=["ts"]).collect()))
    assert got == [(1, "a", 0), (2, "new", 2), (3, "c", 1)]
    with pytest.raises(Exception, match="repeated key"):
        upsert(t, u, ["k"]).collect()


def test_enrich_checks_dimension_keys(spark):
    import pytest
    from tierline.plans.products import enrich
    fact = spark.createDataFrame([(1, 10), (2, 20), (9, 90)], "product_id int, qty int")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "product_id int, category string")
    out = enrich(fact, dim, "product_id", check_unique=True)
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, 10, "x"), (2, 20, "y"), (9, 90, None)]
    dup = dim.unionByName(spark.createDataFrame([(1, "z")], "product_id int, category string"))
    with pytest.raises(ValueError):
        enrich(fact, dup, "product_id", check_unique=True)


def test_table_detail_counts_partition_directories(spark, tmp_dir):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("yr", F.year("o_orderdate"))
    write_table(o, tmp_dir + "/p", partition_by=["yr"], rebalance=True)
    d = table_detail(spark.read.parquet(tmp_dir + "/p")).first()
    years = o.select("yr").distinct().count()
    assert d["num_directories"] == years and d["num_rows"] == o.count()
    assert d["num_files"] <= 2 * years          # rebalanced: few files per directory


def test_only_each_files_first_line_is_a_header(spark, tmp_dir):
    """Header lines that stand again as data are rows (bad ones, if they do not
    fit), also in files with other names, quotes and blanks."""
    import os
    os.makedirs(f"{tmp_dir}/in/d=1")
    files = {"a.csv": ["id,name", "1,x", "id,name", '2,"y, z"', "", " 3, w "], "b.csv": ["key,label", "4,v", "key,label"],
             "c.csv": ["only a header,x"], "d.csv": []}
    for name, lines in files.items():
        with open(f"{tmp_dir}/in/d=1/{name}", "w") as fh:
            fh.write("".join(x + "\n" for x in lines))
    got = read_landing(spark, f"{tmp_dir}/in", schema="id string, name string", bad_rows="drop")
    assert sorted((r["id"], r["name"], r["d"]) for r in got.collect()) == [
        (" 3", " w ", 1), ("1", "x", 1), ("2", "y, z", 1), ("4", "v", 1), ("id", "name", 1), ("key", "label", 1)]
    good, bad = read_landing(spark, f"{tmp_dir}/in", schema="id int, name string", bad_rows="quarantine")
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == [" 3, w ", "id,name", "key,label"]
    assert sorted(r["id"] for r in good.collect()) == [1, 2, 4]


def test_sums_of_small_metrics_keep_their_places(spark):
    from tierline.functions.money import exact_mean, exact_sum
    df = spark.range(1000).select(F.lit(4e-10).alias("x"))
    assert df.agg(exact_sum("x")).first()[0] == 0.0
    assert df.agg(exact_sum("x", places=12)).first()[0] == 4e-7
    assert df.agg(exact_mean("x", places=12)).first()[0] == pytest.approx(4e-10, rel=1e-12)
    with pytest.raises(ValueError, match="places"):
        exact_sum("x", places=25)


def test_old_scratch_tables_are_cleared(spark, tmp_dir, monkeypatch):
    from tierline import session
    monkeypatch.setattr(session, "checkpoint_root", lambda spark: tmp_dir)
    path = session.scratch_path(spark, "clear-me")
    assert path.startswith(tmp_dir)
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark, older_than_hours=1) == 0 and spark.read.parquet(path).count() == 3
    assert session.clear_scratch(spark, older_than_hours=-1) == 1 and not os.path.exists(path)
