"""Table writers for every layer."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DecimalType, DoubleType, LongType, NullType, StringType, StructField,
                               StructType, TimestampNTZType)

from tierline.sinks.replace import path_exists, replace_path, replace_table, table_columns


def save_mode(load_mode: str) -> str:
    """Full loads overwrite, incremental loads append."""
    return {"full": "overwrite", "incremental": "append"}[load_mode]


def write_table(df: DataFrame, dest: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), dynamic_overwrite: bool = False,
                rebalance: bool = False, bloom_cols: Sequence[str] = (),
                bucket_by: tuple[int, Sequence[str]] | None = None,
                max_records_per_file: int | None = None, as_table: bool = False,
                count_rows: bool = True, merge_schema: bool = False) -> dict:
    """Write ``df`` to a path (or a catalog table when ``as_table``).

    * ``partition_by``       directory partitioning (``k=v``)
    * ``dynamic_overwrite``  overwrite only the partitions present in ``df``
    * ``rebalance``          even, fewer files: a ``rebalance`` hint on the
                             partition columns, sized by AQE
    * ``bloom_cols``         Parquet bloom filters for point lookups
    * ``bucket_by``          ``(n, cols)``: bucketed catalog table so later
                             joins / aggregations on ``cols`` skip the shuffle
    * ``max_records_per_file`` caps file size
    * ``merge_schema``       an append may bring new columns: they join the
                             table's schema (older rows read as null).  Without
                             it, and for types the table cannot hold, an
                             append to an existing table fails before writing

    An overwrite goes to a fresh location first and then takes the old one's
    place (``tierline.sinks.replace``): a write that fails leaves the old rows,
    and ``df`` may read the table it replaces.  A catalog table keeps its
    schema: new columns join it, a type it cannot hold is an error.  Bucketed
    overwrites are Spark's own.

    Returns ``{"rows": n}`` measured by an ``Observation`` on the same job
    (no second pass over the data).
    """
    opts = dict(fmt=fmt, partition_by=partition_by, rebalance=rebalance, bloom_cols=bloom_cols,
                max_records_per_file=max_records_per_file, count_rows=count_rows)
    spark = df.sparkSession
    if mode == "overwrite" and bucket_by is None and as_table:
        if fmt != "parquet":
            raise ValueError("catalog tables are stored as parquet")
        if spark.catalog.tableExists(dest):
            df = _fit_stored(df, dest, fmt, True, True)
        df = table_columns(df, partition_by)
        return replace_table(spark, dest, df.schema, lambda at: _write(df, at, "errorifexists", **opts), partition_by, dynamic_overwrite)
    if mode == "overwrite" and bucket_by is None and path_exists(spark, dest):
        return replace_path(spark, dest, lambda at: _write(df, at, "errorifexists", **opts), partition_by, dynamic_overwrite)
    if mode == "append":
        df = _fit_stored(df, dest, fmt, as_table or bucket_by is not None, merge_schema)
    return _write(df, dest, mode, bucket_by=bucket_by, as_table=as_table, **opts)


def _write(df: DataFrame, dest: str, mode: str, fmt: str, partition_by: Sequence[str], rebalance: bool, bloom_cols: Sequence[str],
           max_records_per_file: int | None, count_rows: bool, bucket_by=None, as_table: bool = False) -> dict:
    obs = Observation("write") if count_rows else None
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")) if obs else df
    if rebalance:
        out = out.hint("rebalance", *partition_by) if partition_by else out.hint("rebalance")
    w = out.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for c in bloom_cols:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if bucket_by is not None:
        n, cols = bucket_by
        w = w.bucketBy(int(n), *cols).sortBy(*cols)
        as_table = True
    if as_table:
        w.saveAsTable(dest)
    else:
        w.save(dest)
    return {"rows": obs.get["rows"]} if obs else {}


def stored_schema(spark: SparkSession, dest: str, fmt: str = "parquet", as_table: bool = False) -> StructType | None:
    """The schema of an existing table, or None."""
    if as_table:
        return spark.table(dest).schema if spark.catalog.tableExists(dest) else None
    try:
        return spark.read.format(fmt).option("mergeSchema", "true").load(dest).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _fit_stored(df: DataFrame, dest: str, fmt: str, as_table: bool, merge_schema: bool) -> DataFrame:
    spark = df.sparkSession
    stored = stored_schema(spark, dest, fmt, as_table)
    if stored is None:
        return df
    out = align(df, stored, new_columns=merge_schema)
    new = [f for f in out.schema.fields if f.name not in stored.fieldNames()]
    if new and as_table:
        spark.sql(f"ALTER TABLE {dest} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        out = out.select(*spark.table(dest).columns)
    return out


_INTEGERS = ["tinyint", "smallint", "int", "bigint"]


def common_type(a: DataType, b: DataType) -> DataType | None:
    """The narrower-or-equal type that holds every value of both, or None."""
    x, y = a.simpleString(), b.simpleString()
    if x == y:
        return a
    if x in _INTEGERS and y in _INTEGERS:
        return a if _INTEGERS.index(x) > _INTEGERS.index(y) else b
    if {x, y} == {"float", "double"}:
        return DoubleType()
    for i, o in ((x, y), (y, x)):
        if i in _INTEGERS[:3] and o == "double":
            return DoubleType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def align(df: DataFrame, stored: StructType, new_columns: bool = False) -> DataFrame:
    """``df`` in the stored schema's types and column order, new columns last.
    A value that its stored type cannot hold, or a new column without
    ``new_columns``, is an error: nothing is narrowed or dropped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in stored.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif (common_type(have[f.name], f.dataType) or NullType()).simpleString() == f.dataType.simpleString():
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            raise TypeError(f"column {f.name}: {have[f.name].simpleString()} does not fit the stored "
                            f"{f.dataType.simpleString()}")
    extra = [c for c in df.columns if c not in {f.name for f in stored.fields}]
    if extra and not new_columns:
        raise TypeError(f"columns {extra} are not in the stored table (merge_schema=True adds them)")
    return df.select(*cols, *extra)


def evolve_append(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Additive schema evolution: the union of both schemas, columns missing
    on either side null-filled.  A column with two types takes the type that
    holds both; where there is none, it is an error."""
    have = {f.name: f.dataType for f in existing.schema.fields}
    to = {}
    for f in incoming.schema.fields:
        if f.name in have and have[f.name] != f.dataType:
            to[f.name] = common_type(have[f.name], f.dataType)
            if to[f.name] is None:
                raise TypeError(f"column {f.name}: no type holds {have[f.name].simpleString()} and {f.dataType.simpleString()}")
    widened = [df.select(*[F.col(c).cast(to[c]).alias(c) if c in to else F.col(c) for c in df.columns])
               for df in (existing, incoming)]
    return widened[0].unionByName(widened[1], allowMissingColumns=True)


def write_csv(df: DataFrame, dest: str, quote_all: bool = True, header: bool = True,
              mode: str = "overwrite") -> None:
    """CSV export: header line and every value quoted."""
    df.write.mode(mode).option("header", header).option("quoteAll", quote_all).csv(dest)


AUDIT_SCHEMA = StructType([
    StructField("pipeline_run_id", StringType()), StructField("table_name", StringType()),
    StructField("layer", StringType()), StructField("status", StringType()),
    StructField("processed_at", TimestampNTZType()), StructField("records_processed", LongType())])


def audit_row(spark: SparkSession, run_id: str, table: str, layer: str, status: str,
              records: int, ts: _dt.datetime | None = None) -> DataFrame:
    """One audit record for a pipeline run (UTC time)."""
    when = ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame([(run_id, table, layer, status, when, int(records))], AUDIT_SCHEMA)
