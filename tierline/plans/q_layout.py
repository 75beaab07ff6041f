"""Registered queries: table layout (SNK-6..9, VAL-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.operators.layout import compact, file_ranges, file_sizes, overlap_depth, table_detail, zorder
from tierline.plans import views as V
from tierline.plans.registry import register
from tierline.session import scratch_path
from tierline.sinks.writers import write_table
from tierline.sources.readers import read_table


@register("zorder_multiset", "SNK-7", "SELECT * FROM lineitem")
def q_zorder_multiset(spark, d):
    li = V.table(spark, d, "lineitem")
    path = scratch_path(spark, "zorder")
    write_table(zorder(li, ["l_shipdate", "l_partkey", "l_returnflag"]), path)
    return read_table(spark, path)


@register("compact_multiset", "SNK-6, SNK-8", "SELECT * FROM lineitem")
def q_compact_multiset(spark, d):
    li = V.table(spark, d, "lineitem")
    small = scratch_path(spark, "small-files")
    write_table(li.repartition(32), small)
    path = scratch_path(spark, "compacted")
    write_table(compact(read_table(spark, small), target_file_mb=1), path, rebalance=False)
    return read_table(spark, path)


@register("rebalanced_write", "SNK-8, SNK-2", """
SELECT *, CAST(year(o_orderdate) AS INT) AS yr FROM orders""")
def q_rebalanced_write(spark, d):
    o = V.table(spark, d, "orders").withColumn("yr", F.year("o_orderdate").cast("int"))
    path = scratch_path(spark, "rebalanced")
    write_table(o, path, partition_by=["yr"], rebalance=True)
    back = read_table(spark, path)
    return back.select(*[c for c in o.columns if c != "yr"], F.col("yr").cast("int"))


@register("bloom_lookup", "SNK-9", """
SELECT * FROM orders WHERE o_custkey IN (1, 2, 3, 4, 5)""")
def q_bloom_lookup(spark, d):
    o = V.table(spark, d, "orders")
    path = scratch_path(spark, "bloom")
    write_table(o, path, bloom_cols=["o_custkey"])
    # Point lookups are what bloom filters serve: the IN list is pushed to
    # the scan and row groups whose filter excludes every key are skipped.
    return read_table(spark, path).filter(F.col("o_custkey").isin(1, 2, 3, 4, 5))


@register("table_detail", "VAL-4", """
SELECT 1::BIGINT + max(year(o_orderdate)) - min(year(o_orderdate)) AS num_directories,
       1::BIGINT + max(year(o_orderdate)) - min(year(o_orderdate)) AS num_files,
       count(*) AS num_rows, 7 AS num_columns FROM orders""")
def q_table_detail(spark, d):
    """Of a table written with one file per year."""
    o = V.table(spark, d, "orders").withColumn("yr", F.year("o_orderdate")).select("*")
    path = scratch_path(spark, "detail")
    write_table(o.repartition(1), path, partition_by=["yr"])
    return table_detail(read_table(spark, path)).drop("size_in_bytes")


@register("table_size", "VAL-4", """
SELECT 1::BIGINT AS num_directories, 4::BIGINT AS num_files, count(*) AS num_rows, 6 AS num_columns, true AS size_matches FROM orders""")
def q_table_size(spark, d):
    """The size that the detail reports against the folder's listing."""
    path = scratch_path(spark, "sized")
    write_table(V.table(spark, d, "orders").repartition(4), path)
    listed = sum(file_sizes(spark, path))
    return (table_detail(read_table(spark, path)).withColumn("size_matches", F.col("size_in_bytes") == F.lit(listed)).drop("size_in_bytes"))


@register("layout_depth", "SNK-7, VAL-4", """
SELECT c AS "column", 32::BIGINT AS files, 32 AS unsorted_depth, true AS zorder_is_lower FROM (VALUES ('l_partkey'), ('l_suppkey')) v(c)""")
def q_layout_depth(spark, d):
    """How many files' ranges overlap, per column: dealt rows against the same
    rows in Z-order."""
    li, cols = V.table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"]
    depths = []
    for name, df in (("dealt", li.repartition(32)), ("z", zorder(li, cols, num_partitions=32))):
        path = scratch_path(spark, f"depth-{name}")
        write_table(df, path)
        depths.append(overlap_depth(file_ranges(read_table(spark, path), cols)))
    dealt, z = depths
    return (dealt.join(z.select("column", F.col("mean_depth").alias("z_depth")), "column")
            .select("column", "files", F.col("max_depth").cast("int").alias("unsorted_depth"), (F.col("z_depth") < F.col("mean_depth")).alias("zorder_is_lower")))
