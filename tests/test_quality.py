"""Rules, flags and segments on built rows (the cases the dataset lacks)."""

import datetime as dt

from pyspark.sql.types import StructField, StructType, StringType, IntegerType

from tierline.operators import cleanse as C
from tierline.operators import quality as Q
from tierline.plans import products as P


def test_email_and_phone_rules_on_edge_values(spark):
    rows = [("a.b@example.com", "+12345678901"), ("not-an-email", "555-1234"),
            (None, None), ("", ""), (" a@b.co ", " 1234567890 ")]
    df = spark.createDataFrame(rows, "email string, phone string")
    flags = [r["_data_quality_issues"] for r in Q.flag_issues(df, Q.DEFAULT_RULES).collect()]
    assert flags == ["", "email:valid_format, phone:valid_format", "",
                     "email:valid_format, phone:valid_format",
                     "email:valid_format, phone:valid_format"]
    # Trimming first repairs the padded row.
    trimmed = [r["_data_quality_issues"] for r in Q.flag_issues(C.trim_strings(df)).collect()]
    assert trimmed[4] == ""


def test_future_date_rule_uses_date_columns_and_names(spark):
    df = spark.createDataFrame(
        [(dt.date(2030, 1, 1), "2031-02-03", "2031-02-03"), (dt.date(2020, 1, 1), "garbage", None)],
        "d date, ship_date string, note string")
    assert Q.date_columns(df.schema) == ["d", "ship_date"]
    flags = [r["_data_quality_issues"] for r in Q.flag_issues(df, as_of="2024-01-01").collect()]
    assert flags == ["d:future_date, ship_date:future_date", ""]
    summary = {(r["column"], r["rule"]): r["invalid_count"]
               for r in Q.issue_summary(df, as_of="2024-01-01").collect()}
    assert summary == {("d", "future_date"): 1, ("ship_date", "future_date"): 1}


def test_issue_summary_skips_clean_rules_and_missing_columns(spark):
    df = spark.createDataFrame([("x@y.io",)], "email string")
    assert Q.issue_summary(df).count() == 0


def test_default_segments(spark):
    pat = spark.createDataFrame(
        [(1, 11, 1000.01, 30), (2, 6, 500.01, 31), (3, 5, 500.0, 91), (4, 10, 1000.0, 90)],
        "customer_id int, total_orders int, total_spend double, days_since_last_purchase int")
    got = {r["customer_id"]: (r["spend_segment"], r["frequency_segment"], r["recency_segment"])
           for r in P.segment_customers(pat).collect()}
    assert got == {1: ("High Value", "Frequent", "Active"),
                   2: ("Medium Value", "Regular", "Recent"),
                   3: ("Low Value", "Occasional", "Inactive"),
                   4: ("Medium Value", "Regular", "Recent")}


def test_enforce_schema_modes(spark):
    df = spark.createDataFrame([("7", "x", "extra")], "a string, b string, c string")
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType()),
                         StructField("z", StringType())])
    out = C.enforce_schema(df, schema)
    assert out.columns == ["a", "b", "z"] and out.first()["a"] == 7 and out.first()["z"] is None
    assert C.enforce_schema(df, schema, extra="keep").columns == ["a", "b", "z", "c"]
    try:
        C.enforce_schema(df, schema, extra="error")
        raise AssertionError("expected an error")
    except ValueError:
        pass
    bad = spark.createDataFrame([("nope",)], "a string")
    assert C.enforce_schema(bad, StructType([StructField("a", IntegerType())])).first()["a"] is None


def test_cast_dates_bad_text_is_null(spark):
    df = spark.createDataFrame([("2024-02-03",), ("31/02/2024",), (None,)], "d string")
    vals = [r["d"] for r in C.cast_dates(df, ["d"]).collect()]
    assert vals == [dt.date(2024, 2, 3), None, None]


def test_null_report(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "x string, y int")
    got = {r["column"]: r["null_count"] for r in C.null_report(df, ["x", "y"]).collect()}
    assert got == {"x": 2, "y": 2}


def test_ingest_metadata_has_source_file(spark, tmp_dir):
    spark.range(3).write.parquet(tmp_dir + "/src")
    df = C.with_ingest_metadata(spark.read.parquet(tmp_dir + "/src"), ts="2024-01-01 00:00:00")
    r = df.first()
    assert r["_source_file"].endswith(".parquet") and r["_ingest_timestamp"].year == 2024
    assert "_silver_processed_timestamp" in C.with_processed_ts(df).columns


def test_approximate_distinct_option_is_close(spark):
    from tierline.plans import views as V
    from conftest import SF_SMALL
    s = V.sales(spark, SF_SMALL)
    exact = {r["customer_id"]: r["unique_products_purchased"]
             for r in P.customer_patterns(s, as_of="2001-08-02").collect()}
    approx = {r["customer_id"]: r["unique_products_purchased"]
              for r in P.customer_patterns(s, as_of="2001-08-02", exact_distinct=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(1, 0.05 * v) for k, v in exact.items())
