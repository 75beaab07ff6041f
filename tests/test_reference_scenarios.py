"""The reference's test scenarios, re-authored against our operators."""

import pyspark.sql.functions as F

from tierline.operators.cleanse import fill_defaults
from tierline.operators.dedup import dedup_latest
from tierline.operators.layout import zorder
from tierline.plans import products as P
from tierline.sinks.writers import write_table
from tierline.sources.readers import read_table

ORDER_COLS = ["order_id", "customer_id", "order_date", "product_id",
              "quantity", "unit_price", "total_amount", "status"]


def _order(i, day, product, quantity, price, status="COMPLETED", customer="K-10"):
    return (i, customer, day, product, quantity, price, round(quantity * price, 2), status)


def test_bronze_round_trip_and_status_counts(spark, tmp_dir):
    rows = [_order(i, f"2021-11-{i:02d}", f"SKU{i % 3}", i, 4.25, "SHIPPED" if i % 4 == 0 else "OPEN") for i in range(1, 14)]
    stats = write_table(spark.createDataFrame(rows, ORDER_COLS), tmp_dir + "/bronze")
    back = read_table(spark, tmp_dir + "/bronze")
    assert stats["rows"] == back.count() == 13
    assert set(back.columns) == set(ORDER_COLS)
    assert {r["status"]: r["count"] for r in P.status_counts(back).collect()} == {"SHIPPED": 3, "OPEN": 10}


def test_silver_dedup_keeps_latest_and_fills_nulls(spark):
    rows = [(*_order(i, "2021-11-05", None if i == 8 else "SKU1", 1, 10.0), f"2021-11-05 {h:02d}:15:00")
            for i in (7, 8, 9) for h in (3, 21, 14)[:i - 6]]
    df = spark.createDataFrame(rows, ORDER_COLS + ["seen_at"])
    got = {r["order_id"]: r for r in fill_defaults(dedup_latest(df, ["order_id"], ["seen_at"]), {"product_id": "none"}).collect()}
    assert {i: r["seen_at"][11:13] for i, r in got.items()} == {7: "03", 8: "21", 9: "21"}
    assert got[8]["product_id"] == "none" and got[9]["product_id"] == "SKU1"


def test_gold_daily_category_sales(spark):
    orders = spark.createDataFrame(
        [_order(1, "2020-02-28", "SKU1", 3, 1.5), _order(2, "2020-02-28", "SKU2", 1, 20.25), _order(3, "2020-02-29", "SKU1", 2, 1.5),
         _order(4, "2020-02-29", "SKU3", 5, 0.4), _order(5, "2020-03-01", "SKU2", 2, 20.25), _order(6, "2020-02-28", "SKU3", 10, 0.4)],
        ORDER_COLS)
    products = spark.createDataFrame([("SKU1", "Pencil", "Office"), ("SKU2", "Lamp", "Home"), ("SKU3", "Clip", "Office")],
                                     ["product_id", "product_name", "category"])
    res = P.daily_category_sales(orders, products).collect()
    got = {(str(r["order_date"]), r["category"]): r["daily_revenue"] for r in res}
    assert got == {("2020-02-28", "Home"): 20.25, ("2020-02-28", "Office"): 8.5, ("2020-02-29", "Office"): 5.0, ("2020-03-01", "Home"): 40.5}
    keys = [(str(r["order_date"]), r["category"]) for r in res]
    assert keys == sorted(keys)                                # by day, then category


def test_zorder_preserves_rows(spark, tmp_dir):
    rows = [(i * i % 257, f"name-{i % 19}", i / 4) for i in range(180)]
    df = spark.createDataFrame(rows, ["a", "b", "c"])
    for cols in (["a", "c"], ["a", "b"], ["a"]):
        path = f"{tmp_dir}/z{'-'.join(cols)}"
        write_table(zorder(df, cols), path)
        assert sorted(map(tuple, read_table(spark, path).collect())) == sorted(rows)


def test_end_to_end_bronze_silver_gold(spark, tmp_dir):
    import os
    from tierline.plans.jobs import to_bronze, to_silver
    landing = tmp_dir + "/landing"
    os.makedirs(landing + "/dt=2022-07-09")
    with open(landing + "/dt=2022-07-09/orders-a.csv", "w") as fh:
        fh.write(",".join(ORDER_COLS) + "\n")
        fh.write("31,K-1,2022-07-09,SKU4,1,12.5,12.5,COMPLETED\n")
        fh.write("32,  K-2,2022-07-09,SKU5,4,2.25,9.0,COMPLETED\n")
        fh.write("31,K-1,2022-07-09,SKU4,6,12.5,75.0,COMPLETED\n")
    with open(landing + "/dt=2022-07-09/notes.json", "w") as fh:
        fh.write('{"note": "skipped by the glob"}\n')
    facts = to_bronze(spark, landing, tmp_dir + "/bronze", mode="full", glob="orders*.csv", ingest_ts="2022-07-10 06:00:00")
    assert facts["rows_written"] == 3
    bronze = read_table(spark, tmp_dir + "/bronze")
    assert "dt" in bronze.columns and "_source_file" in bronze.columns
    silver = to_silver(bronze, keys=["order_id"], order_by=["_ingest_timestamp"], ties=["quantity"], as_of="2022-07-31")
    got = {r["order_id"]: r for r in silver.collect()}
    assert set(got) == {31, 32} and got[31]["quantity"] == 6 and got[32]["customer_id"] == "K-2"
    assert got[32]["_data_quality_issues"] == ""
    (day,) = P.daily_sales(silver).collect()
    assert day["total_orders"] == 2 and day["total_sales"] == 84.0


def test_bronze_into_catalog_table_is_incremental(spark, tmp_dir):
    import os
    from tierline.plans.jobs import to_bronze
    land = tmp_dir + "/land"
    os.makedirs(land)
    with open(land + "/orders1.csv", "w") as fh:
        fh.write("order_id,order_date,total_amount\n1,2023-06-01,10.5\n2,2023-06-02,20.0\n")
    spark.sql("DROP TABLE IF EXISTS tl_bronze_orders")
    try:
        f1 = to_bronze(spark, land, "tl_bronze_orders", mode="incremental", watermark_col="order_date",
                       glob="orders*.csv", as_table=True, ingest_ts="2024-01-01 00:00:00")
        assert f1["watermark"] is None and f1["rows_written"] == 2
        with open(land + "/orders2.csv", "w") as fh:
            fh.write("order_id,order_date,total_amount\n2,2023-06-02,20.0\n3,2023-06-03,7.25\n")
        f2 = to_bronze(spark, land, "tl_bronze_orders", mode="incremental", watermark_col="order_date",
                       glob="orders*.csv", as_table=True, ingest_ts="2024-01-02 00:00:00")
        assert str(f2["watermark"]) == "2023-06-02" and f2["rows_written"] == 1 and f2["new_rows"] == 1
        assert sorted(r["order_id"] for r in spark.table("tl_bronze_orders").collect()) == [1, 2, 3]
    finally:
        spark.sql("DROP TABLE IF EXISTS tl_bronze_orders")


def test_gold_tables_in_a_catalog_schema(spark):
    from tierline.plans import views as V
    from tierline.plans.jobs import GOLD_TABLES, to_gold
    from conftest import SF_SMALL
    spark.sql("CREATE DATABASE IF NOT EXISTS tl_gold")
    try:
        written = to_gold(V.sales(spark, SF_SMALL), V.products(spark, SF_SMALL), "tl_gold",
                          as_of="2001-08-02", orders_hdr=V.orders_hdr(spark, SF_SMALL), as_table=True)
        for name in GOLD_TABLES:
            assert spark.table(f"tl_gold.{name}").count() == written[name] > 0
        parts = spark.sql("SHOW PARTITIONS tl_gold.category_performance").count()
        assert parts > 1
    finally:
        spark.sql("DROP DATABASE IF EXISTS tl_gold CASCADE")


def _land(root, name, header, lines, part="p=1"):
    import os
    os.makedirs(f"{root}/{part}", exist_ok=True)
    with open(f"{root}/{part}/{name}.csv", "w") as fh:
        fh.write(header + "\n" + "".join(x + "\n" for x in lines))


def test_bronze_is_optimized_in_place_on_touched_partitions(spark, tmp_dir):
    from tierline.plans.jobs import to_bronze
    land, dest = tmp_dir + "/land", tmp_dir + "/bronze"
    load = dict(glob="*.csv", partition_by=["p"], watermark_col="n", min_rows_to_optimize=10, ingest_ts="2022-01-01 00:00:00")
    for part in (1, 2):
        _land(land, "a", "n,v", [f"{i},{i}.5" for i in range(50)], f"p={part}")
    to_bronze(spark, land, dest, mode="full", optimize=False, **load)
    before = {f for f in read_table(spark, dest).inputFiles() if "p=1" in f}
    for k in range(3):
        land2 = f"{tmp_dir}/land{k}"
        _land(land2, "b", "n,v", [f"{100 + 10 * k + i},1.5" for i in range(5)], "p=2")
        facts = to_bronze(spark, land2, dest, mode="incremental", optimize=k == 2, **load)
    assert facts["files_after"] < facts["files_before"]
    final = read_table(spark, dest)
    assert {f for f in final.inputFiles() if "p=1" in f} == before          # not touched, not rewritten
    assert sorted((r["p"], r["n"]) for r in final.collect()) == sorted(
        [(p, i) for p in (1, 2) for i in range(50)] + [(2, 100 + 10 * k + i) for k in range(3) for i in range(5)])


def test_bronze_adds_columns_and_rejects_type_drift(spark, tmp_dir):
    import pytest
    from tierline.plans.jobs import to_bronze
    dest = tmp_dir + "/bronze"
    load = dict(glob="*.csv", watermark_col="n", ingest_ts="2022-01-01 00:00:00", mode="incremental")
    _land(tmp_dir + "/l1", "a", "n,amount,code", ["1,1.5,x01", "2,2.5,x02"])
    to_bronze(spark, tmp_dir + "/l1", dest, **load)
    _land(tmp_dir + "/l2", "a", "n,amount,code,extra", ["3,7,0042,new"])        # whole numbers, digits in a text column
    to_bronze(spark, tmp_dir + "/l2", dest, **load)
    for _ in range(3):
        rows = sorted((r["n"], r["amount"], r["code"], r["extra"]) for r in read_table(spark, dest).collect())
        assert rows == [(1, 1.5, "x01", None), (2, 2.5, "x02", None), (3, 7.0, "0042", "new")]
    _land(tmp_dir + "/l3", "a", "n,amount,code", ["4,lots,x04"])
    with pytest.raises(TypeError, match="amount"):
        to_bronze(spark, tmp_dir + "/l3", dest, **load)
    assert read_table(spark, dest).count() == 3
