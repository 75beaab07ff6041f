"""The sales products as mergeable partial states (``operators.partials``):
each load of order rows is added to what is stored, whatever days, products or
customers it shares with earlier loads, and the result is that of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.money import as_int, cents, finite, safe_ratio
from tierline.operators.partials import Partial
from tierline.operators.rank import dense_rank_within
from tierline.plans import products as P


def _total(c: str):
    return F.col(c).cast("double") / F.lit(100.0)


def _customers(exact: bool, measures: dict, name: str, column: str) -> dict:
    """An exact distinct count, or a sketch among the measures."""
    if exact:
        return {name: column}
    measures[name] = ("sketch", F.hll_sketch_agg(F.col(column).cast("string")))
    return {}


def _count(exact: bool, name: str):
    return F.col(name) if exact else F.hll_sketch_estimate(name)


def daily_sales(exact_distinct: bool = True) -> Partial:
    m = {"total_orders": ("sum", F.count("order_id")), "cents": ("sum", F.sum(cents("total_amount"))),
         "amounts": ("sum", F.count(finite("total_amount")))}
    distinct = _customers(exact_distinct, m, "unique_customers", "customer_id")

    def finish(s: DataFrame) -> DataFrame:
        return s.select("date", "total_orders", _total("cents").alias("total_sales"), _count(exact_distinct, "unique_customers").alias("unique_customers"),
                        safe_ratio(_total("cents"), F.col("amounts")).alias("average_order_value"))
    return Partial({"date": F.to_date("order_date")}, m, finish, distinct)


def product_performance(products: DataFrame) -> Partial:
    """Names and categories are joined to the merged rows, and the ranks taken
    over them, as they depend on all products."""
    m = {"total_units_sold": ("sum", F.sum("quantity")), "cents": ("sum", F.sum(cents("total_amount"))),
         "prices": ("sum", F.sum("unit_price")), "priced": ("sum", F.count("unit_price")), "order_count": ("sum", F.count("order_id"))}

    def finish(s: DataFrame) -> DataFrame:
        dims = products.select("product_id", "product_name", "category")
        per = s.join(dims, "product_id", "left").select(
            "product_id", "product_name", "category", "total_units_sold", _total("cents").alias("total_revenue"),
            F.round(safe_ratio("prices", "priced"), 4).alias("average_price"), "order_count")
        return dense_rank_within(per, ["category"], "total_revenue", rank_col="revenue_rank")
    return Partial({"product_id": F.col("product_id")}, m, finish)


def category_performance(exact_distinct: bool = True) -> Partial:
    """For rows that carry their product's ``category``."""
    m = {"total_units_sold": ("sum", F.sum("quantity")), "cents": ("sum", F.sum(cents("total_amount")))}
    distinct = {**_customers(exact_distinct, m, "order_count", "order_id"), **_customers(exact_distinct, m, "unique_customers", "customer_id")}

    def finish(s: DataFrame) -> DataFrame:
        return (s.select("category", "year", "month", "total_units_sold", _total("cents").alias("total_revenue"),
                         *[_count(exact_distinct, c).alias(c) for c in ("order_count", "unique_customers")])
                .withColumn("avg_revenue_per_customer", safe_ratio("total_revenue", "unique_customers")))
    keys = {"category": F.col("category"), "year": as_int(F.year("order_date")), "month": as_int(F.month("order_date"))}
    return Partial(keys, m, finish, distinct)


def customer_patterns(as_of=None, exact_distinct: bool = True, segments: dict | None = None) -> Partial:
    m = {"total_orders": ("sum", F.count("order_id")), "cents": ("sum", F.sum(cents("total_amount"))),
         "amounts": ("sum", F.count(finite("total_amount"))), "first_purchase_date": ("min", F.min("order_date")),
         "last_purchase_date": ("max", F.max("order_date"))}
    distinct = _customers(exact_distinct, m, "unique_products_purchased", "product_id")

    def finish(s: DataFrame) -> DataFrame:
        per = s.select("customer_id", "total_orders", _total("cents").alias("total_spend"),
                       safe_ratio(_total("cents"), F.col("amounts")).alias("average_order_value"), "first_purchase_date", "last_purchase_date",
                       _count(exact_distinct, "unique_products_purchased").alias("unique_products_purchased"))
        return P.segment_customers(P.with_recency(per, as_of), **(segments or {}))
    return Partial({"customer_id": F.col("customer_id")}, m, finish, distinct)
