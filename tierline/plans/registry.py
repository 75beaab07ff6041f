"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the operator is expressible in SQL, an independent oracle query
for DuckDB over the same Parquet tables.

Queries are registered by the modules under ``tierline.plans.q_*``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    oracle: str | None
    operator: str          # SURVEY id(s) the query exercises


_REGISTRY: dict[str, Query] = {}


def register(name: str, operator: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = Query(name, fn, oracle, operator)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # Import for the side effect of registering.
    from tierline.plans import q_products, q_cleanse, q_io, q_layout, q_monitoring, q_streaming  # noqa: F401
    if "gold_merge" not in _REGISTRY:
        q_io.register_gold({n: q.oracle for n, q in _REGISTRY.items()})
    return dict(_REGISTRY)
