"""Canonical views: how the generated star-schema tables play the roles of
the orders / products / log tables the data products are written against.

* ``sales``       line grain: lineitem joined to its order
* ``orders_hdr``  order grain
* ``products``    part as a product catalogue
* ``log``         events as a job log / metric table

Status codes are mapped to names.  A status filter is applied on the raw
code so that it reaches the Parquet scan as a pushed filter (a filter on the
mapped name would be a CASE expression the scan cannot use).
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Order status codes and their names.
STATUS_NAMES = {"F": "COMPLETED", "O": "PROCESSING", "P": "CANCELLED"}
STATUS_CODES = {v: k for k, v in STATUS_NAMES.items()}

# Parts up to this size count as active products; the rest are missing from
# ``products_partial`` so that left and inner joins differ.
ACTIVE_MAX_SIZE = 40


# Inferred schemas by session and path: later reads of a session pass the
# schema and skip the footer read (the dataset directories are read-only).
_SCHEMAS: WeakKeyDictionary = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = _SCHEMAS.setdefault(spark, {})
    schema = known.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        known[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def status_name(code_col: str = "o_orderstatus") -> Column:
    c = F.col(code_col)
    expr = None
    for code, name in STATUS_NAMES.items():
        expr = F.when(c == code, name) if expr is None else expr.when(c == code, name)
    return expr


def _orders(spark: SparkSession, sf_dir: str, status: str | None) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    if status is not None:
        o = o.filter(F.col("o_orderstatus") == STATUS_CODES[status])
    return o


def sales(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Line-grain sales: one row per order line.

    lineitem and orders are both fact-sized, so this is a sort-merge join on
    the order key (both sides hash-partitioned by it); AQE turns it into a
    broadcast join on its own when the filtered order side is small.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    o = _orders(spark, sf_dir, status).select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        status_name().alias("status"),
    )


def orders_hdr(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Order-grain orders."""
    return _orders(spark, sf_dir, status).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
        status_name().alias("status"),
    )


def products(spark: SparkSession, sf_dir: str, active_only: bool = False) -> DataFrame:
    p = table(spark, sf_dir, "part")
    if active_only:
        p = p.filter(F.col("p_size") <= ACTIVE_MAX_SIZE)
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("manufacturer"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") <= ACTIVE_MAX_SIZE).alias("is_active"),
    )


def products_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir, active_only=True)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a job log: job, duration, failure flag, usage and resource."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts",
        F.col("user_id").alias("job"),
        F.col("value").alias("duration"),
        (F.col("event_type") == "error").alias("failure"),
        F.col("value").alias("usage"),
        F.col("event_type").alias("resource"),
    )


# ---------------------------------------------------------------------------
# The same views as SQL, for the independent DuckDB oracle.
# ---------------------------------------------------------------------------

STATUS_SQL = ("CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PROCESSING' "
              "WHEN 'P' THEN 'CANCELLED' END")

SALES_SQL = f"""sales AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         l_partkey AS product_id, l_quantity AS quantity,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
         l_extendedprice AS total_amount, {STATUS_SQL} AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ORDERS_HDR_SQL = f"""orders_hdr AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         o_totalprice AS total_amount, {STATUS_SQL} AS status
  FROM orders)"""

PRODUCTS_SQL = f"""products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS manufacturer, p_retailprice AS price, p_size <= {ACTIVE_MAX_SIZE} AS is_active
  FROM part)"""

PRODUCTS_PARTIAL_SQL = f"""products_partial AS (
  SELECT * FROM products WHERE is_active)"""

LOG_SQL = """log AS (
  SELECT event_id, ts, user_id AS job, value AS duration, event_type = 'error' AS failure,
         value AS usage, event_type AS resource
  FROM events)"""


def with_views(*views: str) -> str:
    """``WITH`` prefix holding the named views (in dependency order)."""
    known = {"sales": SALES_SQL, "orders_hdr": ORDERS_HDR_SQL, "products": PRODUCTS_SQL,
             "products_partial": PRODUCTS_PARTIAL_SQL, "log": LOG_SQL}
    order = ["sales", "orders_hdr", "products", "products_partial", "log"]
    wanted = set(views)
    if "products_partial" in wanted:
        wanted.add("products")
    return "WITH " + ",\n".join(known[v] for v in order if v in wanted) + "\n"


def register(spark: SparkSession, sf_dir: str, completed_only: bool = False) -> list[str]:
    """Register the canonical views as temp views (``sales``, ``orders_hdr``,
    ``products``, ``products_partial``, ``log``) so SQL written against the
    reference's tables runs as is through ``spark.sql``."""
    status = "COMPLETED" if completed_only else None
    made = {"sales": sales(spark, sf_dir, status), "orders_hdr": orders_hdr(spark, sf_dir, status),
            "products": products(spark, sf_dir), "products_partial": products_partial(spark, sf_dir),
            "log": log(spark, sf_dir)}
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return list(made)
