"""Z-order data skipping, and incremental-load edge cases."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tierline.operators.layout import zorder
from tierline.session import local_path
from tierline.sinks.writers import write_table
from tierline.sources import incremental as I

from conftest import SF_MID


def _groups_touched(path, box):
    """Row groups whose min/max statistics overlap ``box`` on every column."""
    touched = total = 0
    for f in glob.glob(os.path.join(local_path(path), "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            rg = meta.row_group(g)
            total += 1
            hit = True
            for col, (lo, hi) in box.items():
                st = rg.column(names.index(col)).statistics
                if st.max < lo or st.min > hi:
                    hit = False
            touched += hit
    return touched, total


def test_zorder_lets_filters_skip_row_groups(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    opts = dict(max_records_per_file=2000)
    write_table(li.orderBy(F.rand(7)).repartition(8), tmp_dir + "/random", **opts)
    write_table(zorder(li, ["l_partkey", "l_suppkey"], num_partitions=8), tmp_dir + "/z", **opts)
    box = {"l_partkey": (100, 300), "l_suppkey": (10, 30)}
    r_touched, r_total = _groups_touched(tmp_dir + "/random", box)
    z_touched, z_total = _groups_touched(tmp_dir + "/z", box)
    assert r_touched == r_total                      # random order: nothing can be skipped
    assert z_touched * 4 < z_total                   # clustered: most row groups skipped
    assert spark.read.parquet(tmp_dir + "/z").count() == li.count()


def test_incremental_modes(spark):
    rows = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, None), (4, dt.date(2024, 1, 3))]
    src = spark.createDataFrame(rows, "id int, d date")
    target = src.filter(F.col("id") <= 2)
    wm = I.high_watermark(target, "d")
    assert wm == dt.date(2024, 1, 2)
    assert [r["id"] for r in I.incremental(src, "d", wm).collect()] == [4]
    assert sorted(r["id"] for r in I.incremental(src, "d", wm, inclusive=True).collect()) == [2, 4]
    assert I.incremental(src, "d", wm, mode="full").count() == 4
    assert I.incremental(src, "d", None).count() == 4
    assert I.high_watermark(None, "d") is None and I.high_watermark(target, "") is None
    assert I.high_watermark(src.filter("id > 10"), "d") is None
    assert I.new_rows(src, "d", wm).first()["new_records"] == 1
    sliced = I.slice_window(src, "d", dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert [r["id"] for r in sliced.collect()] == [2]
