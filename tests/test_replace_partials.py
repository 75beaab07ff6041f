"""Safe replacement of stored tables, and gold tables that grow by increments."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tierline.operators import partials
from tierline.operators.partials import Store, apply_load, current, fold
from tierline.plans import increments as N
from tierline.plans import jobs
from tierline.plans import products as P
from tierline.sinks.replace import replace_bucketed
from tierline.sinks.writers import write_table
from tierline.sources.readers import read_table


def rows(spark, n, k=1):
    return spark.range(n).select("id", (F.col("id") * k).alias("v"), (F.col("id") % 3).cast("int").alias("p"))


def breaking(df):
    """``df``, failing in one of its tasks while it is written."""
    bad = F.when(F.col("id") == 7, F.raise_error(F.lit("task lost"))).otherwise(F.lit(True)).cast("boolean")
    return df.repartition(4, "id").filter(bad)


def same(a, b):
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert key(a) == key(b)


@pytest.fixture
def table(spark):
    made = []

    def name(n):
        made.append(n)
        spark.sql(f"DROP TABLE IF EXISTS {n}")
        return n
    yield name
    for n in made:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


@pytest.mark.parametrize("parts", [[], ["p"]])
@pytest.mark.parametrize("as_table", [False, True])
def test_a_failed_overwrite_leaves_the_old_rows(spark, tmp_dir, table, parts, as_table):
    dest = table(f"tl_replace_{len(parts)}") if as_table else f"{tmp_dir}/t"
    read = (lambda: spark.table(dest)) if as_table else (lambda: read_table(spark, dest))
    write_table(rows(spark, 50), dest, partition_by=parts, as_table=as_table)
    for dynamic in ([False, True] if parts else [False]):
        with pytest.raises(Exception, match="task lost"):
            write_table(breaking(rows(spark, 60, 2)), dest, partition_by=parts, as_table=as_table, dynamic_overwrite=dynamic)
        same(read(), rows(spark, 50))
    # the new rows may be read from the table itself
    write_table(read().withColumn("v", F.col("v") + 1), dest, partition_by=parts, as_table=as_table)
    same(read(), rows(spark, 50).withColumn("v", F.col("v") + 1))
    write_table(rows(spark, 20), dest, partition_by=parts, as_table=as_table)
    same(read(), rows(spark, 20))
    if not as_table:
        assert sorted(os.listdir(tmp_dir)) == ["t"] and not [d for d in os.listdir(dest) if "replaced" in d]


def test_partitions_are_replaced_added_and_dropped(spark, table):
    t = table("tl_replace_parts")
    odd = [("a b", 1), ("x=y/z%", 2), (None, 3), ("it's \\ ok", 4)]
    df = spark.createDataFrame(odd, "p string, v int")
    write_table(df, t, partition_by=["p"], as_table=True)
    same(spark.table(t), df)
    new = spark.createDataFrame([("x=y/z%", 20), (None, 30), ("new", 50)], "p string, v int")
    write_table(new, t, partition_by=["p"], as_table=True, dynamic_overwrite=True)
    same(spark.table(t), new.unionByName(df.filter("p in ('a b') or v = 4")))
    write_table(spark.createDataFrame([("new", 1)], "p string, v int"), t, partition_by=["p"], as_table=True, mode="append")
    write_table(new, t, partition_by=["p"], as_table=True)
    same(spark.table(t), new)
    assert spark.sql(f"SHOW PARTITIONS {t}").count() == 3


def test_an_overwrite_keeps_the_tables_schema(spark, table):
    t = table("tl_replace_schema")
    write_table(rows(spark, 5), t, as_table=True)
    with pytest.raises(TypeError, match="does not fit"):
        write_table(rows(spark, 5).withColumn("v", F.lit("text")), t, as_table=True)
    write_table(rows(spark, 6).withColumn("extra", F.lit(1)), t, as_table=True)
    same(spark.table(t), rows(spark, 6).withColumn("extra", F.lit(1)))


def test_replaced_locations_are_kept_once(spark, table):
    t = table("tl_replace_old")
    for n in range(1, 6):
        write_table(rows(spark, n), t, as_table=True)
    base = spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri.removeprefix("file:")
    assert len([d for d in os.listdir(base) if d.startswith(f"{t}-")]) == 2


def test_bucketed_replacement_joins_without_a_shuffle(spark, table):
    t = table("tl_replace_buckets")
    for k in (1, 2):
        replace_bucketed(rows(spark, 2000, k), t, 8, ["id"])
    same(spark.table(t), rows(spark, 2000, 2))
    plan = spark.table(t).groupBy("id").count()._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]
    with pytest.raises(Exception, match="task lost"):
        replace_bucketed(breaking(rows(spark, 60)), t, 8, ["id"])
    same(spark.table(t), rows(spark, 2000, 2))


@pytest.mark.parametrize("parts", [[], ["yr"]])
@pytest.mark.parametrize("as_table", [False, True])
def test_a_failed_compaction_leaves_the_rows(spark, tmp_dir, table, monkeypatch, parts, as_table):
    land = f"{tmp_dir}/land"
    spark.range(40).selectExpr("id", "cast(2000 + id % 2 as int) yr", "id as wm").repartition(5).write.option("header", True).csv(f"{land}/a")
    dest = table(f"tl_compact_{len(parts)}") if as_table else f"{tmp_dir}/bronze"
    load = dict(watermark_col="wm", glob="*.csv", ingest_ts="2024-01-01 00:00:00", partition_by=parts, as_table=as_table, min_rows_to_optimize=1)
    jobs.to_bronze(spark, f"{land}/a", dest, mode="full", optimize=False, **load)
    read = (lambda: spark.table(dest)) if as_table else (lambda: read_table(spark, dest))
    spark.range(40, 80).selectExpr("id", "cast(2000 + id % 2 as int) yr", "id as wm").repartition(5).write.option("header", True).csv(f"{land}/b")
    real = jobs.write_table

    def failing(df, *args, **opts):
        return real(breaking(df) if opts.get("mode") == "overwrite" else df, *args, **opts)
    monkeypatch.setattr(jobs, "write_table", failing)
    with pytest.raises(Exception, match="task lost"):
        jobs.to_bronze(spark, f"{land}/b", dest, **load)
    assert sorted(r["id"] for r in read().collect()) == list(range(80))
    monkeypatch.setattr(jobs, "write_table", real)
    before = len(read().inputFiles())
    spark.range(80, 84).selectExpr("id", "cast(2000 + id % 2 as int) yr", "id as wm").repartition(2).write.option("header", True).csv(f"{land}/c")
    facts = jobs.to_bronze(spark, f"{land}/c", dest, **load)
    assert sorted(r["id"] for r in read().collect()) == list(range(84)) and facts["files_after"] <= 2 < before + 2


def test_compaction_is_worth_it_only_for_small_files():
    from tierline.operators.layout import worth_compacting
    mb = 1 << 20
    assert worth_compacting([mb] * 5) and not worth_compacting([mb]) and not worth_compacting([])
    assert not worth_compacting([128 * mb] * 10 + [mb] * 20) and worth_compacting([128 * mb] * 2 + [50 * mb] * 2)


# -- increments -------------------------------------------------------------------

ORDER = "order_id bigint, customer_id bigint, order_date timestamp_ntz, product_id bigint, quantity double, unit_price double, total_amount double, status string, category string"


def orders(spark, n=400, seed=1):
    import datetime as dt
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hot = rng.random() < 0.34
        out.append((rng.randint(1, n // 3), 1 if hot else rng.choice([None, *range(2, 30)]), rng.choice([None, *[dt.datetime(2024, 1, 1 + d, h) for d in range(4) for h in (0, 23)]]),
                    rng.choice([None, 1, 2, 3]), float(rng.randint(1, 9)), rng.choice([2.5, 0.25]), rng.choice([None, float("nan"), 0.285, 10.0, 7.99]),
                    "COMPLETED", rng.choice([None, "a", "b"])))
    return spark.createDataFrame(out, ORDER)


PARTIALS = {
    "daily": (lambda: N.daily_sales(), lambda o: P.daily_sales(o)),
    "category": (lambda: N.category_performance(), lambda o: P.category_performance(o.drop("category"), o.sparkSession.createDataFrame(
        [(1, "a"), (2, "b")], "product_id bigint, category string"))),
    "customer": (lambda: N.customer_patterns(as_of="2024-02-01"), lambda o: P.segment_customers(P.customer_patterns(o, as_of="2024-02-01"))),
}


@pytest.mark.parametrize(("kind", "as_table"), [("daily", True), ("category", False), ("customer", False)])
def test_loads_in_any_split_add_up(spark, tmp_dir, kind, as_table):
    part, whole = PARTIALS[kind]
    o = orders(spark)
    if kind == "category":
        o = o.withColumn("category", F.when(F.col("product_id") == 1, "a").when(F.col("product_id") == 2, "b"))
    o = o.withColumn("load", F.pmod(F.xxhash64("order_id", "total_amount"), F.lit(3))).cache()
    tag = f"tl_part_{kind}_{tmp_dir[-8:].lower().replace('-', '_')}"
    store = Store(spark, tag if as_table else f"{tmp_dir}/{kind}", as_table, buckets=4)
    mine = lambda *k: o.filter(F.col("load").isin(*k)).drop("load")
    for k in (0, 1, 1):                                               # the second is run twice
        apply_load(mine(k), part(), store, f"load {k}")
    same(current(part(), store), whole(mine(0, 1)))
    fold(part(), store)
    same(current(part(), store), whole(mine(0, 1)))
    with pytest.raises(ValueError, match="folded"):
        apply_load(mine(1), part(), store, "load 1")
    apply_load(mine(2), part(), store, "load 2")
    same(current(part(), store), whole(o.drop("load")))
    fold(part(), store)
    assert store.loads() == []
    same(current(part(), store), whole(o.drop("load")))


def test_a_fold_cut_short_doubles_nothing(spark, tmp_dir, monkeypatch):
    o = orders(spark)
    store, part = Store(spark, f"{tmp_dir}/s"), N.daily_sales()
    apply_load(o, part, store, "a")
    with monkeypatch.context() as m:
        m.setattr(partials, "drop_partition", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            fold(part, store)
    same(current(part, store), P.daily_sales(o))
    apply_load(o, part, store, "b")
    fold(part, store)
    two = current(part, store).select("date", "total_orders", "unique_customers")
    same(two, P.daily_sales(o.unionByName(o)).select("date", "total_orders", "unique_customers"))


def test_sketches_merge(spark, tmp_dir):
    o = orders(spark)
    store, part = Store(spark, f"{tmp_dir}/s"), N.daily_sales(exact_distinct=False)
    for k in (0, 1):
        apply_load(o.filter(F.coalesce(F.col("customer_id") % 2, F.lit(0)) == k), part, store, str(k))
    same(current(part, store), P.daily_sales(o))          # few values: the sketch is exact


def test_a_failed_gold_merge_leaves_the_table(spark, tmp_dir, monkeypatch):
    o, root = orders(spark), f"{tmp_dir}/gold"
    products = spark.createDataFrame([(1, "n", "a", "m", 1.0, True)], "product_id bigint, product_name string, category string, manufacturer string, price double, is_active boolean")
    only = ["daily_sales_summary"]
    jobs.to_gold(o, products, root, mode="merge", load_id="a", only=only)
    want = read_table(spark, f"{root}/{only[0]}").collect()
    real = jobs.write_table
    broken = F.raise_error(F.lit("task lost")).cast("bigint")
    monkeypatch.setattr(jobs, "write_table", lambda df, *a, **k: real(df.withColumn("total_orders", broken), *a, **k))
    with pytest.raises(Exception, match="task lost"):
        jobs.to_gold(o, products, root, mode="merge", load_id="b", only=only)
    assert sorted(map(str, read_table(spark, f"{root}/{only[0]}").collect())) == sorted(map(str, want))
    monkeypatch.setattr(jobs, "write_table", real)
    jobs.to_gold(o, products, root, mode="merge", load_id="b", only=only)
    same(read_table(spark, f"{root}/{only[0]}"), P.daily_sales(o.unionByName(o)))
    with pytest.raises(ValueError, match="load_id"):
        jobs.to_gold(o, products, root, mode="merge", only=only)
