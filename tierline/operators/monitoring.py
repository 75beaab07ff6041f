"""Monitoring queries over job logs and metric tables.

All of them are a time bucket (``window``) plus a grouped aggregate, which
Spark combines map-side, so a hot job or resource never lands whole in one
task.  They take column names so any log/metric table fits, and work on
batch and streaming DataFrames alike (for streams add a watermark first,
see ``tierline.streaming``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.money import METRIC_PLACES, exact_mean, exact_sum

# The reference's alert windows and thresholds.
FAILURE_WINDOW = "15 minutes"
USAGE_WINDOW = "1 day"
USAGE_THRESHOLD = 5000
GIB = 1024 ** 3


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bucket(ts: str, window: str):
    w = F.window(ts, window)
    return w.start.alias("window_start"), w.end.alias("window_end")


def failure_alerts(log: DataFrame, ts: str = "ts", is_failure="failure",
                   window: str = FAILURE_WINDOW, min_count: int = 1) -> DataFrame:
    """Windows holding at least ``min_count`` failures (the alert fires
    when the count is above zero)."""
    start, end = _bucket(ts, window)
    return (log.groupBy(start, end)
            .agg(F.count_if(_c(is_failure)).alias("failures"))
            .filter(F.col("failures") >= min_count))


def usage_alerts(log: DataFrame, ts: str = "ts", resource: str = "resource", usage: str = "usage",
                 window: str = USAGE_WINDOW, threshold: float = USAGE_THRESHOLD,
                 places: int = METRIC_PLACES) -> DataFrame:
    """(window, resource) whose summed usage is above ``threshold``."""
    start, end = _bucket(ts, window)
    return (log.groupBy(start, end, resource)
            .agg(exact_sum(usage, places).alias("total_usage"))
            .filter(F.col("total_usage") > threshold))


def metric_rollup(log: DataFrame, ts: str, window: str, by: Sequence[str], value: str,
                  how: str = "sum", scale: float = 1.0, name: str = "value", places: int = METRIC_PLACES) -> DataFrame:
    """Per time bucket and ``by`` columns: the sum or average of ``value``
    (exact to ``places`` of each value, NaN counts as missing), divided by
    ``scale``.  Small units need more places: seconds of nanosecond timings, say,
    twelve."""
    start, _ = _bucket(ts, window)
    if how == "sum":
        agg = exact_sum(value, places)
    elif how == "avg":
        agg = exact_mean(value, places)
    else:
        raise ValueError(f"how must be sum or avg, not {how!r}")
    if scale != 1.0:
        agg = agg / F.lit(float(scale))
    return log.groupBy(start, *by).agg(agg.alias(name))


def job_performance(log: DataFrame, job: str = "job", duration: str = "duration",
                    ok="ok") -> DataFrame:
    """Per job: average duration in seconds (from milliseconds) and the
    success rate in percent, slowest first."""
    avg_s = exact_mean(duration) / F.lit(1000.0)
    rate = F.lit(100.0) * F.count_if(_c(ok)).cast("double") / F.count(F.lit(1)).cast("double")
    return (log.groupBy(job).agg(avg_s.alias("avg_duration_s"), rate.alias("success_rate"))
            .orderBy(F.desc("avg_duration_s"), F.asc(job)))
