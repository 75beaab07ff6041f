"""Plan-shape tests: pushdown, pruning, no Python in the hot path, bounded windows."""

import datetime as dt

from pyspark.sql import functions as F

from tierline.plans import products as P
from tierline.plans import views as V
from tierline.sources import incremental as I
from tierline.sinks.writers import write_table
from tierline.sources.readers import read_table

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_filter_reaches_the_scan(spark):
    p = plan(P.daily_sales(V.orders_hdr(spark, SF_SMALL, status="COMPLETED")))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p


def test_watermark_is_a_pushed_literal_filter(spark):
    src = V.table(spark, SF_SMALL, "orders")
    out = I.incremental(src, "o_orderdate", dt.datetime(2001, 1, 1))
    assert "GreaterThan(o_orderdate,2001-01-01" in plan(out)


def test_scan_reads_only_needed_columns(spark):
    p = plan(P.category_monthly_report(V.sales(spark, SF_SMALL, "COMPLETED"), V.products(spark, SF_SMALL)))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in p


def test_no_python_in_products(spark):
    s, p = V.sales(spark, SF_SMALL), V.products(spark, SF_SMALL)
    for df in [P.daily_sales(V.orders_hdr(spark, SF_SMALL)), P.category_performance(s, p),
               P.customer_patterns(s, as_of="2001-08-02"), P.category_monthly_report(s, p)]:
        text = plan(df)
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_rank_never_windows_on_the_group_alone(spark):
    df = P.product_performance(V.sales(spark, SF_SMALL, "COMPLETED"), V.products(spark, SF_SMALL))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # Every window is partitioned by the range-partition id plus the group,
    # or runs over the small per-partition table.
    assert "Window" in text
    lines = plan(df).replace(" ", "").splitlines()
    for i, line in enumerate(lines):
        if "Exchangehashpartitioning(category" in line:
            # Only the per-(range partition, category) run table is hashed on
            # the category alone; it has at most #partitions rows per category.
            assert "HashAggregate(keys=[__rk_pid" in lines[i + 1], lines[i:i + 2]


def test_partition_filter_prunes_directories(spark, tmp_dir):
    o = V.table(spark, SF_SMALL, "orders").withColumn("yr", F.year("o_orderdate"))
    write_table(o, tmp_dir + "/o", partition_by=["yr"])
    q = read_table(spark, tmp_dir + "/o").filter(F.col("yr") == 1996)
    assert "PartitionFilters: [isnotnull(yr" in plan(q)


def test_dedup_limits_each_key_before_the_shuffle(spark):
    from tierline.operators.dedup import dedup_latest
    df = dedup_latest(V.table(spark, SF_SMALL, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
