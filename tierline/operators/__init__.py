"""DataFrame -> DataFrame operators."""

from tierline.operators.cleanse import (cast_dates, enforce_schema, fill_defaults, null_report,
                                        trim_strings, with_ingest_metadata, with_processed_ts)
from tierline.operators.dedup import dedup_latest
from tierline.operators.layout import compact, needs_compaction, table_detail, zorder
from tierline.operators.merge import snapshot_diff, upsert
from tierline.operators.monitoring import failure_alerts, job_performance, metric_rollup, usage_alerts
from tierline.operators.preview import preview
from tierline.operators.quality import (DEFAULT_RULES, Rule, email_rule, flag_issues, future_date_rule,
                                        issue_summary, phone_rule, profile)
from tierline.operators.rank import dense_rank_within

__all__ = [
    "cast_dates", "enforce_schema", "fill_defaults", "null_report", "trim_strings",
    "with_ingest_metadata", "with_processed_ts", "dedup_latest", "compact", "needs_compaction",
    "table_detail", "zorder", "snapshot_diff", "upsert", "failure_alerts", "job_performance",
    "metric_rollup", "usage_alerts", "preview", "DEFAULT_RULES", "Rule", "email_rule", "flag_issues",
    "future_date_rule", "issue_summary", "phone_rule", "profile", "dense_rank_within",
]
