"""Small, ordered previews of a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 10, order_by: Sequence = ()) -> DataFrame:
    """The first ``n`` rows in a stated order (an unordered ``limit`` is
    nondeterministic).  Spark plans ordered-limit as a per-task top-n plus
    one merge of at most ``n`` rows per task, never a full sort."""
    if not order_by:
        raise ValueError("preview needs an order so the rows shown are reproducible")
    return df.orderBy(*order_by).limit(n)
