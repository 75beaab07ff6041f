"""High-watermark incremental loading.

The watermark is one scalar (``MAX(col)`` of the target).  It comes back to
the driver as a literal on purpose: a literal comparison reaches the Parquet
scan as a pushed filter, so row groups and files entirely below the mark are
skipped by their min/max statistics, which a join against a one-row table
would not do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.keys import row_text
from tierline.sources.footers import footer_aggregates


def high_watermark(target: DataFrame | None, col: str | None, stored: bool = False):
    """``MAX(col)`` over the target, or ``None`` when there is no target,
    no watermark column or the target is empty.  Errors propagate: a failed
    lookup must not turn into a silent full reload.  A ``stored`` target (a
    plain scan of Parquet files) is asked by its file footers first."""
    if target is None or not col:
        return None
    if stored:
        return footer_aggregates(target, {"m": ("max", col)})["m"]
    return target.agg(F.max(col).alias("m")).first()["m"]


def watermark_frame(target: DataFrame, col: str) -> DataFrame:
    """The watermark as a one-row DataFrame (``max_watermark``)."""
    return target.agg(F.max(col).alias("max_watermark"))


def incremental(source: DataFrame, col: str | None, watermark, mode: str = "incremental",
                inclusive: bool = False) -> DataFrame:
    """Source rows newer than the watermark.

    ``mode="full"``, no column or no watermark -> every row.  ``inclusive``
    also keeps rows equal to the mark (late rows sharing the last value;
    ``overlap_load`` leaves out those that are loaded already).  Rows whose column is null are
    never newer.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"mode must be full or incremental, not {mode!r}")
    if mode == "full" or not col or watermark is None:
        return source
    c = F.col(col)
    return source.filter(c >= F.lit(watermark) if inclusive else c > F.lit(watermark))


def overlap_load(source: DataFrame, target: DataFrame, col: str, watermark, ignore: Sequence[str] = ()) -> DataFrame:
    """Source rows newer than the watermark, and rows equal to it that the
    target does not have yet: late rows that share the last value are not lost,
    and a load that is run again adds nothing.

    Rows count as the same if all columns of the source are equal (nulls too)
    in the target's types; columns that only the target has, and those to
    ``ignore`` (ingest metadata), are not compared.  So a row that repeats a loaded one in every
    column is taken for it.  Only the boundary value is read from the target
    (a pushed filter) and compared, by an anti join on the whole row's text."""
    if watermark is None:
        return source
    kinds = {f.name: f.dataType for f in target.schema.fields}
    here = [f.name for f in source.schema.fields if f.name in kinds and f.name not in ignore]
    new = [f.name for f in source.schema.fields if f.name not in kinds and f.name not in ignore]
    old = target.filter(F.col(col) == F.lit(watermark)).select(*here)
    text = "__row"
    seen = old.select(row_text(old.schema).alias(text)).distinct()
    # A column the target has not got yet: only its nulls can be loaded rows.
    fresh = F.lit(False)
    for c in new:
        fresh = fresh | F.col(c).isNotNull()
    typed = source.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in source.columns])
    mine = row_text(typed.select(*here).schema)
    late = (typed.filter(F.col(col) == F.lit(watermark)).withColumn(text, F.when(fresh, F.lit(None)).otherwise(mine))
            .join(seen, text, "left_anti").drop(text))
    return typed.filter(F.col(col) > F.lit(watermark)).unionByName(late)


def slice_window(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows with ``start <= col < end`` (either bound may be None)."""
    c = F.col(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start))
    if end is not None:
        cond = cond & (c < F.lit(end))
    return df.filter(cond)


def new_rows(target: DataFrame, col: str, watermark) -> DataFrame:
    """``new_records``: rows of the target above the previous watermark."""
    src = target if watermark is None else target.filter(F.col(col) > F.lit(watermark))
    return src.agg(F.count(F.lit(1)).alias("new_records"))


def table_counts(tables: dict) -> DataFrame:
    """(table, row_count) for named DataFrames, in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
