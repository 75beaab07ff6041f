"""Registered queries: monitoring (MON-1..5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.operators import monitoring as M
from tierline.plans import views as V
from tierline.plans.registry import register

_DEC = "CAST(SUM(CAST({} AS DECIMAL(28,9))) AS DOUBLE)"


@register("failure_alerts", "MON-1, AGG-11", V.with_views("log") + """
SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start,
       time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' AS window_end,
       count(*) FILTER (WHERE failure) AS failures
FROM log GROUP BY 1, 2 HAVING count(*) FILTER (WHERE failure) >= 1""")
def q_failure_alerts(spark, d):
    return M.failure_alerts(V.log(spark, d))


@register("usage_alerts", "MON-2", V.with_views("log") + f"""
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
       time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end, resource,
       {_DEC.format('usage')} AS total_usage
FROM log GROUP BY 1, 2, 3 HAVING {_DEC.format('usage')} > 5000""")
def q_usage_alerts(spark, d):
    return M.usage_alerts(V.log(spark, d))


@register("metric_rollup_daily", "MON-3", V.with_views("log") + f"""
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, resource, {_DEC.format('usage')} AS total_cost
FROM log GROUP BY 1, 2""")
def q_metric_rollup_daily(spark, d):
    return M.metric_rollup(V.log(spark, d), "ts", "1 day", ["resource"], "usage", "sum", name="total_cost")


@register("metric_rollup_hourly", "MON-4", V.with_views("log") + f"""
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       ({_DEC.format('usage')} / CAST(count(usage) AS DOUBLE)) / CAST({M.GIB} AS DOUBLE) AS avg_used_gb
FROM log GROUP BY 1""")
def q_metric_rollup_hourly(spark, d):
    return M.metric_rollup(V.log(spark, d), "ts", "1 hour", [], "usage", "avg",
                           scale=float(M.GIB), name="avg_used_gb")


@register("job_performance", "MON-5, SRT-2", V.with_views("log") + f"""
SELECT job, ({_DEC.format('duration')} / CAST(count(duration) AS DOUBLE)) / CAST(1000 AS DOUBLE) AS avg_duration_s,
       CAST(100 AS DOUBLE) * CAST(count(*) FILTER (WHERE NOT failure) AS DOUBLE) / CAST(count(*) AS DOUBLE)
         AS success_rate
FROM log GROUP BY job ORDER BY avg_duration_s DESC, job""")
def q_job_performance(spark, d):
    log = V.log(spark, d).withColumn("ok", ~F.col("failure"))
    return M.job_performance(log, "job", "duration", "ok")


@register("metric_rollup_fine", "MON-3, MON-4, AGG-5", V.with_views("log") + f"""
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, resource, {_DEC.format('usage / 8')} AS total_cost
FROM log GROUP BY 1, 2""")
def q_metric_rollup_fine(spark, d):
    """Digits below a hundredth are kept."""
    log = V.log(spark, d).withColumn("usage", F.col("usage") / F.lit(8.0))
    return M.metric_rollup(log, "ts", "1 day", ["resource"], "usage", "sum", name="total_cost")
