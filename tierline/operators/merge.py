"""Upserts and snapshot diffs on key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.operators.dedup import dedup_latest

CHANGE = "_change_type"


def one_per_key(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``updates``, failing at run time if a key is repeated (a merge with two
    rows for one key has no defined result)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    ok = F.when(n > 1, F.raise_error(F.concat(F.lit("upsert: repeated key "), F.to_json(F.struct(*keys))))).otherwise(F.lit(True))
    return updates.withColumn("__ok", ok.cast("boolean")).filter("__ok").drop("__ok")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           latest_by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``updates`` win; target rows whose key is not in ``updates``
    stay.  Keys compare null-safe.  When the update batch may hold several
    rows per key, ``latest_by`` keeps only the latest of them (by those
    columns, see ``dedup_latest``); without it a repeated key is an error.
    Columns that only one side has are kept and null-filled.

    An anti join plus a union: the target is shuffled on the keys once
    (broadcast instead when the update batch is under the broadcast
    threshold), and AQE splits skewed key partitions of the anti join.
    """
    keys = list(keys)
    # The anti join takes the keys as they come (repeats do not matter there).
    upd_keys = updates.select(*[F.col(k).alias(f"__u_{k}") for k in keys])
    updates = dedup_latest(updates, keys, latest_by) if latest_by else one_per_key(updates, keys)
    cond = None
    for k in keys:
        e = target[k].eqNullSafe(upd_keys[f"__u_{k}"])
        cond = e if cond is None else cond & e
    kept = target.join(upd_keys, cond, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes from ``old`` to ``new`` as rows with ``_change_type``:
    ``insert``, ``delete``, ``update_preimage`` and ``update_postimage``.

    Built without pairing rows: both snapshots are tagged and grouped on the
    whole row (identical rows cancel, map-side combined), then each key is
    classified from a per-key aggregate.  Nulls compare equal, and a key
    repeated in a snapshot never multiplies rows.  Columns that only one
    snapshot has are compared as null on the other side.
    """
    keys = list(keys)
    tagged = (old.select("*", F.lit(1).alias("__o"), F.lit(0).alias("__n"))
              .unionByName(new.select("*", F.lit(0).alias("__o"), F.lit(1).alias("__n")), allowMissingColumns=True))
    cols = [c for c in tagged.columns if c not in ("__o", "__n")]
    per_row = tagged.groupBy(*cols).agg(F.sum("__o").alias("__co"), F.sum("__n").alias("__cn"))
    # A row present k times in old and m times in new contributes |k - m| copies.
    changed = (per_row.filter(F.col("__co") != F.col("__cn"))
               .withColumn("__side", F.when(F.col("__co") > F.col("__cn"), "old").otherwise("new"))
               .withColumn("__copies", F.abs(F.col("__co") - F.col("__cn"))))
    per_key = changed.groupBy(*keys).agg(
        F.max((F.col("__side") == "old").cast("int")).alias("__has_old"),
        F.max((F.col("__side") == "new").cast("int")).alias("__has_new"))
    pk = per_key.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__has_old", "__has_new")
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        cond = e if cond is None else cond & e
    j = changed.join(pk, cond, "inner")
    kind = (F.when((F.col("__side") == "old") & (F.col("__has_new") == 1), "update_preimage")
            .when(F.col("__side") == "old", "delete")
            .when(F.col("__has_old") == 1, "update_postimage")
            .otherwise("insert"))
    out = j.select(*[F.col(c) for c in cols], kind.alias(CHANGE), F.col("__copies"))
    return _expand_copies(out, "__copies")


# Copies of one row are expanded in chunks of this many.
_COPY_CHUNK = 4096


def _expand_copies(df: DataFrame, n_col: str) -> DataFrame:
    """Each row ``n_col`` times.  Counts are cut into chunks, the chunks are
    spread over tasks, and each task expands its chunks - so a group of
    copies holding a large share of the table never lands in one task."""
    keep = [c for c in df.columns if c != n_col]
    n = F.col(n_col).cast("long")
    chunks = df.select(*keep, n.alias("__n"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((n - 1) / _COPY_CHUNK).cast("long"))).alias("__c"))
    # An explicit partition count: AQE would otherwise coalesce this shuffle
    # of chunk descriptors by its own small size.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = F.least(F.lit(_COPY_CHUNK).cast("long"), F.col("__n") - F.col("__c") * _COPY_CHUNK)
    return (chunks.repartition(parts, "__c", *keep[:1])
            .select(*keep, F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("__i")).drop("__i"))


__all__ = ["upsert", "one_per_key", "snapshot_diff", "CHANGE"]
