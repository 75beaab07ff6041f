"""The analytics (gold) data products.

Inputs follow the reference's table shapes:

* orders:   order_id, customer_id, order_date, product_id, quantity,
            unit_price, total_amount, status (line grain; order grain works
            for the products that do not need product columns)
* products: product_id, product_name, category, manufacturer, price, is_active

Money is summed exactly (``money_sum``); calendar parts, ranks and day
differences are INT.  Status, reference date and segment thresholds are
parameters whose defaults are the reference's values.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.money import as_int, money_sum, mean_of_money, safe_ratio
from tierline.operators.rank import dense_rank_within

# The reference's status name and segment rules.
COMPLETED = "COMPLETED"
SPEND_THRESHOLDS = (1000, 500)           # > High Value, > Medium Value, else Low Value
FREQUENCY_THRESHOLDS = (10, 5)           # > Frequent, > Regular, else Occasional
RECENCY_THRESHOLDS = (30, 90)            # <= Active, <= Recent, else Inactive
SPEND_LABELS = ("High Value", "Medium Value", "Low Value")
FREQUENCY_LABELS = ("Frequent", "Regular", "Occasional")
RECENCY_LABELS = ("Active", "Recent", "Inactive")


def _distinct(c: str, exact: bool, rsd: float = 0.01) -> Column:
    """Distinct count: exact (a shuffle keyed by group + value) or a
    HyperLogLog++ estimate whose sketches combine map-side (a shuffle of one
    small sketch per group and task), for inputs where the exact form's
    near-row-level shuffle is too wide."""
    return F.countDistinct(c) if exact else F.approx_count_distinct(c, rsd)


def _completed(orders: DataFrame, status: str | None) -> DataFrame:
    return orders if status is None else orders.filter(F.col("status") == status)


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of).cast("date")
    return F.lit(str(as_of)).cast("date")


def daily_sales(orders: DataFrame, status: str | None = COMPLETED,
                exact_distinct: bool = True) -> DataFrame:
    """Per calendar day of completed orders: rows, revenue, distinct
    customers, average order value."""
    return (_completed(orders, status)
            .groupBy(F.to_date("order_date").alias("date"))
            .agg(F.count("order_id").alias("total_orders"),
                 money_sum("total_amount").alias("total_sales"),
                 _distinct("customer_id", exact_distinct).alias("unique_customers"),
                 mean_of_money("total_amount").alias("average_order_value")))


def product_performance(orders: DataFrame, products: DataFrame,
                        status: str | None = COMPLETED) -> DataFrame:
    """Per product of completed lines (left join, so lines with an unknown
    product stay, with null name and category): units, revenue, plain
    (unweighted) average unit price, line count, and the dense revenue rank
    inside the category (highest first; the null category ranks on its own).

    Unit prices are arbitrary doubles, so their mean is rounded to 4 places:
    unrounded, its last bits would depend on the order rows are summed in,
    i.e. on the partitioning."""
    lines = _completed(orders, status)
    dims = products.select("product_id", "product_name", "category")
    joined = lines.join(dims, "product_id", "left")
    per_product = (joined.groupBy("product_id", "product_name", "category")
                   .agg(F.sum("quantity").alias("total_units_sold"),
                        money_sum("total_amount").alias("total_revenue"),
                        F.round(F.avg("unit_price"), 4).alias("average_price"),
                        F.count("order_id").alias("order_count")))
    return dense_rank_within(per_product, ["category"], "total_revenue", rank_col="revenue_rank")


def category_performance(orders: DataFrame, products: DataFrame,
                         status: str | None = COMPLETED, exact_distinct: bool = True) -> DataFrame:
    """Per category x year x month of completed lines (left join): units,
    revenue, distinct orders, distinct customers, revenue per customer.
    Stored partitioned by (year, month)."""
    lines = _completed(orders, status)
    joined = lines.join(products.select("product_id", "category"), "product_id", "left")
    return (joined.groupBy("category",
                           as_int(F.year("order_date")).alias("year"),
                           as_int(F.month("order_date")).alias("month"))
            .agg(F.sum("quantity").alias("total_units_sold"),
                 money_sum("total_amount").alias("total_revenue"),
                 _distinct("order_id", exact_distinct).alias("order_count"),
                 _distinct("customer_id", exact_distinct).alias("unique_customers"))
            .withColumn("avg_revenue_per_customer",
                        safe_ratio("total_revenue", "unique_customers")))


def customer_patterns(orders: DataFrame, as_of=None, status: str | None = None,
                      exact_distinct: bool = True) -> DataFrame:
    """Per customer over all statuses (the reference applies no status
    filter here): rows, spend, average, first/last purchase, distinct
    products, days since the last purchase (relative to ``as_of``, default
    today) and lifespan in days."""
    src = _completed(orders, status)
    agg = (src.groupBy("customer_id")
           .agg(F.count("order_id").alias("total_orders"),
                money_sum("total_amount").alias("total_spend"),
                mean_of_money("total_amount").alias("average_order_value"),
                F.min("order_date").alias("first_purchase_date"),
                F.max("order_date").alias("last_purchase_date"),
                _distinct("product_id", exact_distinct).alias("unique_products_purchased")))
    return with_recency(agg, as_of)


def with_recency(patterns: DataFrame, as_of=None) -> DataFrame:
    """Adds the days since the last purchase and the lifespan in days."""
    return (patterns
            .withColumn("days_since_last_purchase",
                        as_int(F.datediff(_as_of(as_of), F.to_date("last_purchase_date"))))
            .withColumn("customer_lifespan_days",
                        as_int(F.datediff(F.to_date("last_purchase_date"),
                                          F.to_date("first_purchase_date")))))


def _tiers(c: Column, limits, labels, above: bool) -> Column:
    hi, lo = limits
    if above:
        return F.when(c > hi, labels[0]).when(c > lo, labels[1]).otherwise(labels[2])
    return F.when(c <= hi, labels[0]).when(c <= lo, labels[1]).otherwise(labels[2])


def segment_customers(patterns: DataFrame, spend=SPEND_THRESHOLDS, freq=FREQUENCY_THRESHOLDS,
                      recency=RECENCY_THRESHOLDS) -> DataFrame:
    """Spend, frequency and recency segments on top of ``customer_patterns``."""
    return (patterns
            .withColumn("spend_segment", _tiers(F.col("total_spend"), spend, SPEND_LABELS, True))
            .withColumn("frequency_segment", _tiers(F.col("total_orders"), freq, FREQUENCY_LABELS, True))
            .withColumn("recency_segment",
                        _tiers(F.col("days_since_last_purchase"), recency, RECENCY_LABELS, False)))


def dim_product(products: DataFrame) -> DataFrame:
    """The product dimension."""
    return products.select("product_id", "product_name", "category", "manufacturer",
                           "price", "is_active")


def category_monthly_report(orders: DataFrame, products: DataFrame,
                            status: str | None = COMPLETED, exact_distinct: bool = True) -> DataFrame:
    """Category x year x month over completed lines with a known product
    (inner join): distinct orders, revenue, units and the weighted average
    unit price (revenue / units), ordered by category, year, month."""
    lines = _completed(orders, status)
    joined = lines.join(products.select("product_id", "category"), "product_id", "inner")
    return (joined.groupBy("category",
                           as_int(F.year("order_date")).alias("year"),
                           as_int(F.month("order_date")).alias("month"))
            .agg(_distinct("order_id", exact_distinct).alias("orders"),
                 money_sum("total_amount").alias("revenue"),
                 F.sum("quantity").alias("units_sold"))
            .withColumn("average_unit_price", safe_ratio("revenue", "units_sold"))
            .orderBy("category", "year", "month"))


def daily_category_sales(orders: DataFrame, products: DataFrame,
                         status: str | None = COMPLETED, exact_distinct: bool = True) -> DataFrame:
    """Revenue and distinct orders per day and category (inner join),
    ordered by day and category."""
    lines = _completed(orders, status)
    joined = lines.join(products.select("product_id", "category"), "product_id", "inner")
    return (joined.groupBy(F.to_date("order_date").alias("order_date"), "category")
            .agg(money_sum("total_amount").alias("daily_revenue"),
                 _distinct("order_id", exact_distinct).alias("order_count"))
            .orderBy("order_date", "category"))


def status_counts(orders: DataFrame) -> DataFrame:
    """Rows per status."""
    return orders.groupBy("status").agg(F.count(F.lit(1)).alias("count"))


def enrich(fact: DataFrame, dim: DataFrame, key: str | list, how: str = "left",
           check_unique: bool = False) -> DataFrame:
    """Fact -> dimension equi-join; with ``how="left"`` unmatched facts keep
    null attributes.  Spark broadcasts the dimension only when its size is
    under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks with the
    real size at runtime); otherwise both sides shuffle on the key and AQE
    splits skewed key partitions.

    ``check_unique`` first verifies the dimension key is unique (an action);
    a duplicated dimension key would multiply fact rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if check_unique:
        dup = dim.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError(f"dimension key {keys} is not unique")
    return fact.join(dim, keys, how)
