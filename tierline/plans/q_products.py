"""Registered queries: data products, joins and ranking (GLD-*, JOIN-1, WIN-2)."""

from __future__ import annotations

from tierline.plans import products as P
from tierline.plans import views as V
from tierline.plans.registry import register
from tierline.operators.rank import dense_rank_within

# Reference date and thresholds for the customer queries (see FIXTURES.md).
AS_OF = "2001-08-02"
SEG_SPEND = (2_400_000, 1_740_000)
SEG_FREQ = (45, 33)
SEG_RECENCY = (98, 265)

MONEY = "CAST(SUM(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


def _m(c: str) -> str:
    return MONEY.format(c)


@register("daily_sales", "GLD-1, FLT-1, AGG-2, AGG-5, AGG-6, AGG-8", V.with_views("orders_hdr") + f"""
SELECT CAST(order_date AS DATE) AS date, COUNT(order_id) AS total_orders,
       {_m('total_amount')} AS total_sales, COUNT(DISTINCT customer_id) AS unique_customers,
       {_m('total_amount')} / CAST(COUNT(total_amount) AS DOUBLE) AS average_order_value
FROM orders_hdr WHERE status = 'COMPLETED' GROUP BY 1""")
def q_daily_sales(spark, d):
    return P.daily_sales(V.orders_hdr(spark, d, status="COMPLETED"))


@register("product_performance", "GLD-2, JOIN-1, WIN-2", V.with_views("sales", "products") + f"""
, agg AS (
  SELECT s.product_id, p.product_name, p.category, SUM(s.quantity) AS total_units_sold,
         {_m('s.total_amount')} AS total_revenue, ROUND(AVG(s.unit_price), 4) AS average_price,
         COUNT(s.order_id) AS order_count
  FROM sales s LEFT JOIN products p ON s.product_id = p.product_id
  WHERE s.status = 'COMPLETED' GROUP BY 1, 2, 3)
SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST) AS INT)
          AS revenue_rank
FROM agg""")
def q_product_performance(spark, d):
    return P.product_performance(V.sales(spark, d, status="COMPLETED"), V.products(spark, d))


@register("category_performance", "GLD-3, JOIN-1, AGG-8, AGG-9", V.with_views("sales", "products") + f"""
SELECT p.category, CAST(year(s.order_date) AS INT) AS year, CAST(month(s.order_date) AS INT) AS month,
       SUM(s.quantity) AS total_units_sold, {_m('s.total_amount')} AS total_revenue,
       COUNT(DISTINCT s.order_id) AS order_count, COUNT(DISTINCT s.customer_id) AS unique_customers,
       {_m('s.total_amount')} / CAST(COUNT(DISTINCT s.customer_id) AS DOUBLE) AS avg_revenue_per_customer
FROM sales s LEFT JOIN products p ON s.product_id = p.product_id
WHERE s.status = 'COMPLETED' GROUP BY 1, 2, 3""")
def q_category_performance(spark, d):
    return P.category_performance(V.sales(spark, d, status="COMPLETED"), V.products(spark, d))


_PATTERNS_SQL = f"""
, pat AS (
  SELECT customer_id, COUNT(order_id) AS total_orders, {_m('total_amount')} AS total_spend,
         {_m('total_amount')} / CAST(COUNT(total_amount) AS DOUBLE) AS average_order_value,
         MIN(order_date) AS first_purchase_date, MAX(order_date) AS last_purchase_date,
         COUNT(DISTINCT product_id) AS unique_products_purchased
  FROM sales GROUP BY customer_id)
, pat2 AS (
  SELECT *, CAST(date_diff('day', CAST(last_purchase_date AS DATE), DATE '{AS_OF}') AS INT)
              AS days_since_last_purchase,
            CAST(date_diff('day', CAST(first_purchase_date AS DATE), CAST(last_purchase_date AS DATE)) AS INT)
              AS customer_lifespan_days
  FROM pat)"""


@register("customer_patterns", "GLD-4", V.with_views("sales") + _PATTERNS_SQL + "\nSELECT * FROM pat2")
def q_customer_patterns(spark, d):
    return P.customer_patterns(V.sales(spark, d), as_of=AS_OF)


@register("customer_segments", "GLD-5", V.with_views("sales") + _PATTERNS_SQL + f"""
SELECT *,
  CASE WHEN total_spend > {SEG_SPEND[0]} THEN 'High Value' WHEN total_spend > {SEG_SPEND[1]}
       THEN 'Medium Value' ELSE 'Low Value' END AS spend_segment,
  CASE WHEN total_orders > {SEG_FREQ[0]} THEN 'Frequent' WHEN total_orders > {SEG_FREQ[1]}
       THEN 'Regular' ELSE 'Occasional' END AS frequency_segment,
  CASE WHEN days_since_last_purchase <= {SEG_RECENCY[0]} THEN 'Active'
       WHEN days_since_last_purchase <= {SEG_RECENCY[1]} THEN 'Recent' ELSE 'Inactive' END AS recency_segment
FROM pat2""")
def q_customer_segments(spark, d):
    pat = P.customer_patterns(V.sales(spark, d), as_of=AS_OF)
    return P.segment_customers(pat, spend=SEG_SPEND, freq=SEG_FREQ, recency=SEG_RECENCY)


@register("dim_product", "GLD-6, PRJ-3", V.with_views("products") + """
SELECT product_id, product_name, category, manufacturer, price, is_active FROM products""")
def q_dim_product(spark, d):
    return P.dim_product(V.products(spark, d))


CATEGORY_MONTHLY_SQL = V.with_views("sales", "products") + f"""
SELECT p.category, CAST(year(s.order_date) AS INT) AS year, CAST(month(s.order_date) AS INT) AS month,
       COUNT(DISTINCT s.order_id) AS orders, {_m('s.total_amount')} AS revenue,
       SUM(s.quantity) AS units_sold,
       {_m('s.total_amount')} / SUM(s.quantity) AS average_unit_price
FROM sales s JOIN products p ON s.product_id = p.product_id
WHERE s.status = 'COMPLETED'
GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""


@register("category_monthly_report", "GLD-7, JOIN-2, SRT-1, AGG-3, AGG-5, AGG-9", CATEGORY_MONTHLY_SQL)
def q_category_monthly_report(spark, d):
    return P.category_monthly_report(V.sales(spark, d, status="COMPLETED"), V.products(spark, d))


@register("daily_category_sales", "GLD-8, JOIN-2", V.with_views("sales", "products") + f"""
SELECT CAST(s.order_date AS DATE) AS order_date, p.category, {_m('s.total_amount')} AS daily_revenue,
       COUNT(DISTINCT s.order_id) AS order_count
FROM sales s JOIN products p ON s.product_id = p.product_id
WHERE s.status = 'COMPLETED' GROUP BY 1, 2 ORDER BY 1, 2""")
def q_daily_category_sales(spark, d):
    return P.daily_category_sales(V.sales(spark, d, status="COMPLETED"), V.products(spark, d))


@register("status_counts", "GLD-9, AGG-1", V.with_views("orders_hdr") + """
SELECT status, COUNT(*) AS count FROM orders_hdr GROUP BY status""")
def q_status_counts(spark, d):
    return P.status_counts(V.orders_hdr(spark, d))


@register("enrich_left", "JOIN-1, JOIN-3", V.with_views("sales", "products_partial") + """
SELECT s.order_id, s.product_id, s.quantity, s.total_amount, p.product_name, p.category
FROM sales s LEFT JOIN products_partial p ON s.product_id = p.product_id""")
def q_enrich_left(spark, d):
    facts = V.sales(spark, d).select("order_id", "product_id", "quantity", "total_amount")
    dims = V.products_partial(spark, d).select("product_id", "product_name", "category")
    return P.enrich(facts, dims, "product_id", "left").select(
        "order_id", "product_id", "quantity", "total_amount", "product_name", "category")


@register("rank_within", "WIN-2", """
SELECT p_partkey, p_type, p_retailprice,
       CAST(DENSE_RANK() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC NULLS LAST) AS INT) AS price_rank
FROM part""")
def q_rank_within(spark, d):
    part = V.table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice")
    return dense_rank_within(part, ["p_type"], "p_retailprice", rank_col="price_rank", materialize=False)


# The flagship as a SQL string over temp views, the way the reference runs it.
CATEGORY_MONTHLY_SPARK_SQL = """
SELECT p.category, year(o.order_date) AS year, month(o.order_date) AS month,
       count(DISTINCT o.order_id) AS orders,
       CAST(SUM(CAST(o.total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       SUM(o.quantity) AS units_sold,
       try_divide(CAST(SUM(CAST(o.total_amount AS DECIMAL(18,2))) AS DOUBLE), SUM(o.quantity))
         AS average_unit_price
FROM sales o JOIN products p ON o.product_id = p.product_id
WHERE o.status = 'COMPLETED'
GROUP BY p.category, year(o.order_date), month(o.order_date)
ORDER BY p.category, year, month"""


@register("category_monthly_report_sql", "GLD-7, JOIN-2, SRC-9", CATEGORY_MONTHLY_SQL)
def q_category_monthly_report_sql(spark, d):
    V.register(spark, d, completed_only=True)
    return spark.sql(CATEGORY_MONTHLY_SPARK_SQL)


@register("top_products", "LIM-1, VAL-5, SRT-2, GLD-2", V.with_views("sales", "products") + f"""
SELECT s.product_id, p.product_name, p.category, {_m('s.total_amount')} AS total_revenue
FROM sales s LEFT JOIN products p ON s.product_id = p.product_id
WHERE s.status = 'COMPLETED' GROUP BY 1, 2, 3
ORDER BY total_revenue DESC, s.product_id LIMIT 10""")
def q_top_products(spark, d):
    # A top-k report: the limit is the feature.  Spark plans an ordered limit
    # as a per-task top-10 and one merge of at most 10 rows per task.
    from pyspark.sql import functions as F
    from tierline.functions.money import money_sum
    from tierline.operators.preview import preview
    lines = V.sales(spark, d, status="COMPLETED").join(
        V.products(spark, d).select("product_id", "product_name", "category"), "product_id", "left")
    per_product = lines.groupBy("product_id", "product_name", "category").agg(
        money_sum("total_amount").alias("total_revenue"))
    return preview(per_product, 10, [F.desc("total_revenue"), F.asc("product_id")])
