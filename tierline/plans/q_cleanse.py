"""Registered queries: cleansing, dedup and data quality (CLN-*, DQ-*, VAL-3)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, LongType, StringType, StructField, StructType)

from tierline.operators import cleanse as C
from tierline.operators import quality as Q
from tierline.operators.dedup import dedup_latest
from tierline.plans import views as V
from tierline.plans.registry import register

DQ_AS_OF = "2001-01-01"


# A contact table derived from customer: e-mails and phones that are valid,
# invalid, null or empty, and a sign-up date that is partly in the future.
def contacts(spark, d):
    c = V.table(spark, d, "customer")
    k = F.col("c_custkey")
    email = (F.when(k % 4 == 0, F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")))
             .when(k % 4 == 1, F.regexp_replace("c_name", "#", ""))
             .when(k % 4 == 2, F.lit(None).cast("string"))
             .otherwise(F.lit("")))
    phone = (F.when(k % 5 <= 1, F.concat(F.lit("+1"), F.lpad(k.cast("string"), 10, "5")))
             .when(k % 5 == 2, F.concat(F.lit("555-"), k.cast("string")))
             .when(k % 5 == 3, F.lit(None).cast("string"))
             .otherwise(F.lit("")))
    signup = F.date_add(F.lit("2000-06-01").cast("date"), (k % 400).cast("int"))
    return c.select(k, email.alias("email"), phone.alias("phone"), signup.alias("signup_date"))


CONTACTS_SQL = """WITH contacts AS (
  SELECT c_custkey,
    CASE c_custkey % 4 WHEN 0 THEN lower(replace(c_name, '#', '.')) || '@example.com'
         WHEN 1 THEN replace(c_name, '#', '') WHEN 2 THEN NULL ELSE '' END AS email,
    CASE WHEN c_custkey % 5 <= 1 THEN '+1' || lpad(CAST(c_custkey AS VARCHAR), 10, '5')
         WHEN c_custkey % 5 = 2 THEN '555-' || CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 5 = 3 THEN NULL ELSE '' END AS phone,
    DATE '2000-06-01' + CAST(c_custkey % 400 AS INTEGER) AS signup_date
  FROM customer)
"""
# The reference's two patterns, in DuckDB's dialect.
EMAIL_BAD = r"NOT regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')"
PHONE_BAD = r"NOT regexp_matches(phone, '^\+?[0-9]{10,15}$')"
DATE_BAD = f"signup_date > DATE '{DQ_AS_OF}'"


@register("dq_flags", "DQ-1..5, FLT-2, FLT-3", CONTACTS_SQL + f"""
SELECT *, concat_ws(', ',
    CASE WHEN {EMAIL_BAD} THEN 'email:valid_format' END,
    CASE WHEN {PHONE_BAD} THEN 'phone:valid_format' END,
    CASE WHEN {DATE_BAD} THEN 'signup_date:future_date' END) AS _data_quality_issues
FROM contacts""")
def q_dq_flags(spark, d):
    return Q.flag_issues(contacts(spark, d), Q.DEFAULT_RULES, as_of=DQ_AS_OF)


@register("dq_summary", "DQ-6, AGG-11", CONTACTS_SQL + f"""
SELECT * FROM (
  SELECT 'email' AS column, 'valid_format' AS rule, count(*) FILTER (WHERE {EMAIL_BAD}) AS invalid_count,
         'Invalid email format' AS message FROM contacts
  UNION ALL
  SELECT 'phone', 'valid_format', count(*) FILTER (WHERE {PHONE_BAD}), 'Invalid phone number format' FROM contacts
  UNION ALL
  SELECT 'signup_date', 'future_date', count(*) FILTER (WHERE {DATE_BAD}), 'Date is in the future' FROM contacts
) WHERE invalid_count > 0""")
def q_dq_summary(spark, d):
    return Q.issue_summary(contacts(spark, d), Q.DEFAULT_RULES, as_of=DQ_AS_OF)


@register("future_date_rule", "DQ-4", V.with_views("orders_hdr") + f"""
SELECT 'order_date' AS column, 'future_date' AS rule, count(*) AS invalid_count,
       'Date is in the future' AS message
FROM orders_hdr WHERE CAST(order_date AS DATE) > DATE '{DQ_AS_OF}' HAVING count(*) > 0""")
def q_future_date_rule(spark, d):
    return Q.issue_summary(V.orders_hdr(spark, d), [Q.future_date_rule()], as_of=DQ_AS_OF)


@register("dedup_latest", "CLN-6, WIN-1", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_latest(spark, d):
    return dedup_latest(V.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                        ["l_shipdate", "l_partkey"])


@register("trim_strings", "CLN-1", """
SELECT c_custkey, trim(' ' || c_name || '  ') AS c_name, c_nationkey, c_acctbal,
       trim('  ' || c_mktsegment || ' ') AS c_mktsegment
FROM customer""")
def q_trim_strings(spark, d):
    c = V.table(spark, d, "customer")
    padded = c.select("c_custkey", F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("c_name"),
                      "c_nationkey", "c_acctbal",
                      F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("c_mktsegment"))
    return C.trim_strings(padded)


@register("cast_dates", "CLN-2", """
SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 10 = 0 THEN 'not a date'
                                 ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS order_date
FROM orders""")
def q_cast_dates(spark, d):
    o = V.table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return C.cast_dates(o.select("o_orderkey", text.alias("order_date")), ["order_date"])


@register("null_report", "CLN-3", """
SELECT 'p_brand' AS column, count(*) FILTER (WHERE NULLIF(p_brand, 'Brand#1') IS NULL) AS null_count FROM part
UNION ALL SELECT 'p_name', count(*) FILTER (WHERE p_name IS NULL) FROM part
UNION ALL SELECT 'p_size', count(*) FILTER (WHERE NULLIF(p_size, 1) IS NULL) FROM part""")
def q_null_report(spark, d):
    p = V.table(spark, d, "part").select(
        F.expr("nullif(p_brand, 'Brand#1')").alias("p_brand"), "p_name",
        F.expr("nullif(p_size, 1)").alias("p_size"))
    return C.null_report(p, ["p_brand", "p_name", "p_size"])


CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()),
    StructField("c_name", StringType()),
    StructField("c_nationkey", LongType()),
    StructField("c_acctbal", DecimalType(12, 2)),
    StructField("c_phone", StringType()),
])


@register("enforce_schema", "CLN-4, PRJ-4", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       TRY_CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_phone
FROM customer""")
def q_enforce_schema(spark, d):
    return C.enforce_schema(V.table(spark, d, "customer"), CUSTOMER_SCHEMA, extra="drop")


@register("fill_defaults", "CLN-5", """
SELECT p_partkey, COALESCE(NULLIF(p_brand, 'Brand#1'), 'UNKNOWN') AS p_brand FROM part""")
def q_fill_defaults(spark, d):
    p = V.table(spark, d, "part").select("p_partkey", F.expr("nullif(p_brand, 'Brand#1')").alias("p_brand"))
    return C.fill_defaults(p, {"p_brand": "UNKNOWN"})


_PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _profile_sql(cols):
    parts = []
    for c in cols:
        pct = ", ".join(
            f"(SELECT min(v) FROM r_{c} WHERE rn >= ceil({p} * n)) AS p{int(p * 100)}"
            for p in (0.25, 0.5, 0.75))
        parts.append(f"""SELECT '{c}' AS column, count({c}) AS count,
  CAST(SUM(CAST({c} AS DECIMAL(38,9))) AS DOUBLE) / CAST(count({c}) AS DOUBLE) AS mean,
  ROUND(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, {pct},
  CAST(max({c}) AS DOUBLE) AS max FROM lineitem""")
    ranks = ",\n".join(
        f"r_{c} AS (SELECT CAST({c} AS DOUBLE) AS v, row_number() OVER (ORDER BY {c}) AS rn, "
        f"count(*) OVER () AS n FROM lineitem WHERE {c} IS NOT NULL)" for c in cols)
    return "WITH " + ranks + "\n" + "\nUNION ALL\n".join(parts)


@register("profile_exact", "VAL-3", _profile_sql(_PROFILE_COLS))
def q_profile_exact(spark, d):
    return Q.profile(V.table(spark, d, "lineitem"), _PROFILE_COLS)


SKETCH_K = 400


@register("profile_sketches", "VAL-3", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, count({c}) AS count, true AS p25_close, true AS p50_close, true AS p75_close FROM lineitem" for c in _PROFILE_COLS))
def q_profile_sketches(spark, d):
    """One sketch per return flag, merged; the ranks of its quartiles among all
    rows are within the sketch's bound."""
    li = V.table(spark, d, "lineitem")
    merged = Q.merge_sketches(Q.profile_sketches(li, _PROFILE_COLS, by=["l_returnflag"], k=SKETCH_K), _PROFILE_COLS)
    told = {r["column"]: r for r in Q.sketch_profile(merged, _PROFILE_COLS).collect()}
    bound = Q.kll_rank_bound(SKETCH_K)

    def close(c, i, p):
        q, n = F.lit(told[c][f"q{i}"]), F.count(c)
        return ((F.count_if(F.col(c) < q) <= (p + bound) * n) & (F.count_if(F.col(c) <= q) >= (p - bound) * n)).alias(f"{c}{i}")

    one = li.agg(*[close(c, i, p) for c in _PROFILE_COLS for i, p in enumerate(Q.PERCENTILES)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(told[c]["count"]).cast("bigint").alias("count"),
                     *[F.col(f"{c}{i}").alias(f"p{int(p * 100)}_close") for i, p in enumerate(Q.PERCENTILES)]) for c in _PROFILE_COLS]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
