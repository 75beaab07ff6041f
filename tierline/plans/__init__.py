"""Data products, layer jobs, canonical views and the query registry."""

from tierline.plans.jobs import publish_silver, to_bronze, to_gold, to_silver
from tierline.plans.products import (category_monthly_report, category_performance, customer_patterns,
                                     daily_category_sales, daily_sales, dim_product, enrich,
                                     product_performance, segment_customers, status_counts)

__all__ = ["publish_silver", "to_bronze", "to_gold", "to_silver", "category_monthly_report", "category_performance",
           "customer_patterns", "daily_category_sales", "daily_sales", "dim_product", "enrich",
           "product_performance", "segment_customers", "status_counts"]
