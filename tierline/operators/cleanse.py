"""Cleansing and schema enforcement for the validated (silver) layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tierline.functions.rules import as_date

INGEST_TS = "_ingest_timestamp"
SOURCE_FILE = "_source_file"
PROCESSED_TS = "_silver_processed_timestamp"


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every top-level string column, in one projection."""
    return df.select(*[
        F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields])


def cast_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Turn the listed columns into DATE; unparseable text becomes null
    (``try_to_date``) instead of failing the job under ANSI mode."""
    wanted = set(cols)
    return df.select(*[
        as_date(f.name, f.dataType).alias(f.name) if f.name in wanted else F.col(f.name)
        for f in df.schema.fields])


def enforce_schema(df: DataFrame, schema: StructType, extra: str = "drop") -> DataFrame:
    """Make ``df`` follow ``schema``: declared order, declared types
    (``try_cast``: a value that does not fit becomes null), missing columns
    added as null.  Extra columns are dropped (``extra="drop"``), kept after
    the declared ones (``"keep"``) or rejected (``"error"``)."""
    if extra not in ("drop", "keep", "error"):
        raise ValueError(f"extra must be drop, keep or error, not {extra!r}")
    have = {f.name: f for f in df.schema.fields}
    declared = {f.name for f in schema.fields}
    unknown = [c for c in df.columns if c not in declared]
    if unknown and extra == "error":
        raise ValueError(f"columns not in the declared schema: {unknown}")
    out: list[Column] = []
    for f in schema.fields:
        if f.name in have:
            src = F.col(f.name)
            out.append((src if have[f.name].dataType == f.dataType else src.try_cast(f.dataType))
                       .alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    if extra == "keep":
        out.extend(F.col(c) for c in unknown)
    return df.select(*out)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls with a per-column default (``{"product_id": "UNKNOWN"}``)."""
    return df.fillna(dict(defaults))


def with_ingest_metadata(df: DataFrame, ts: Column | str | None = None,
                         source_file: bool = True) -> DataFrame:
    """Add ``_ingest_timestamp`` (now, or a fixed value for reproducible
    runs) and ``_source_file`` (the file each row came from).  Must be called
    on a file-source DataFrame when ``source_file`` is set."""
    stamp = F.current_timestamp() if ts is None else (F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts)
    out = df.withColumn(INGEST_TS, stamp)
    if source_file:
        out = out.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    return out


def with_processed_ts(df: DataFrame, ts: Column | str | None = None) -> DataFrame:
    """Add the validated-layer processing timestamp."""
    stamp = F.current_timestamp() if ts is None else (F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts)
    return df.withColumn(PROCESSED_TS, stamp)


def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, null_count) for the required columns, from a single pass."""
    if not cols:
        raise ValueError("null_report needs at least one column")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, null_count)")
