"""Structured Streaming jobs."""

from tierline.streaming.pipelines import (current_state, read_stream, stream_alerts, stream_dedup,
                                          stream_to_bronze, stream_upsert, stream_usage_alerts)

__all__ = ["current_state", "read_stream", "stream_alerts", "stream_dedup", "stream_to_bronze",
           "stream_upsert", "stream_usage_alerts"]
