"""Dense rank within groups, without sending a whole group to one task.

``Window.partitionBy(g).orderBy(v)`` hashes every row of a group into one
task.  With a handful of groups (e.g. six product categories) that is six
tasks sorting the whole input, and one hot group sorts a third of it.

Here the rank is computed on the distinct (group, value) pairs, which an
aggregate produces with map-side combining (so a value repeated a billion
times costs one pair):

1. The pairs are range-partitioned on (group, value) - every task holds a
   contiguous, evenly sized slice of the global order, and no pair repeats -
   and each records its partition id.  The result is checkpointed, which
   fixes the numbering on disk and cuts the lineage.
2. Local dense rank inside (partition, group): a window whose groups are
   bounded by the size of one range partition.
3. Per (partition, group) the number of pairs.  A group spans a run of
   consecutive partitions, so this table has at most
   ``#partitions + #groups`` rows and its per-group window is bounded by the
   number of partitions.
4. rank = local rank + pairs of the same group in earlier partitions.
5. The ranks are joined back on (group, value), null-safe: broadcast when
   the pair table is under the broadcast threshold, otherwise a sort-merge
   join whose hot input keys AQE splits (the pair side is unique per key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.session import checkpoint_root

_PID = "__rk_pid"
_LOCAL = "__rk_local"
_ND = "__rk_nd"
_OFF = "__rk_off"


def rank_pairs(pairs: DataFrame, by: Sequence[str], metric: str, rank_col: str,
               descending: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Dense rank of ``metric`` within ``by`` for rows that are unique on
    (``by``, ``metric``); returns (``by``, ``metric``, ``rank_col``)."""
    by = list(by)
    spark = pairs.sparkSession
    checkpoint_root(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    value_order = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_first()
    order = [F.col(c).asc_nulls_first() for c in by] + [value_order]

    placed = (pairs.repartitionByRange(n, *order)
              .withColumn(_PID, F.spark_partition_id())
              .checkpoint(eager=True))

    local = placed.withColumn(_LOCAL, F.row_number().over(Window.partitionBy(_PID, *by).orderBy(value_order)))

    runs = local.groupBy(_PID, *by).agg(F.count(F.lit(1)).alias(_ND))
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # Renamed so the join back is not a self-join on identically named columns.
    ren = {c: f"__rk_g{i}" for i, c in enumerate([_PID, *by])}
    runs = runs.select(*[F.col(c).alias(ren[c]) for c in [_PID, *by]],
                       F.coalesce(F.sum(_ND).over(before), F.lit(0)).alias(_OFF))

    cond = None
    for c in [_PID, *by]:
        e = F.col(c).eqNullSafe(F.col(ren[c]))
        cond = e if cond is None else cond & e
    return local.join(runs, cond, "inner").select(
        *[F.col(c) for c in by], F.col(metric),
        (F.col(_LOCAL) + F.col(_OFF)).cast("int").alias(rank_col))


def dense_rank_within(df: DataFrame, by: Sequence[str], metric: str, rank_col: str = "rank",
                      descending: bool = True, num_partitions: int | None = None,
                      materialize: bool = True) -> DataFrame:
    """Add ``rank_col``: the dense rank of ``metric`` inside each ``by`` group.

    Equal to ``dense_rank().over(Window.partitionBy(*by).orderBy(metric))``
    (descending by default; nulls last when descending, first when
    ascending, as Spark orders them), with null group keys forming their own
    group.  The rank is an INT.

    ``materialize`` checkpoints the input first, because it is read twice
    (for the pairs and for the join back) and is typically an aggregate
    that should not be recomputed; pass False for a plain table scan.
    """
    by = list(by)
    base = df
    if materialize:
        checkpoint_root(df.sparkSession)
        base = df.checkpoint(eager=True)
    pairs = base.select(*by, metric).distinct()
    ranked = rank_pairs(pairs, by, metric, "__rk_rank", descending, num_partitions)
    ren = {c: f"__rk_k{i}" for i, c in enumerate([*by, metric])}
    ranked = ranked.select(*[F.col(c).alias(ren[c]) for c in [*by, metric]], F.col("__rk_rank"))
    cond = None
    for c in [*by, metric]:
        e = base[c].eqNullSafe(ranked[ren[c]])
        cond = e if cond is None else cond & e
    return base.join(ranked, cond, "inner").select(
        *[base[c] for c in df.columns], F.col("__rk_rank").alias(rank_col))
