"""The layer jobs, composed from the operators.

``to_bronze``: read a landing area -> keep rows above the target's
high-watermark -> add ingest metadata -> write (overwrite for full loads,
append for incremental ones) -> validate.  One scan of the source: the
written row count comes from an ``Observation`` on the write itself.

``to_silver``: trim -> cast dates -> flag quality issues -> latest row per
key -> processing timestamp, as one lazy plan (one projection, one
aggregation shuffle for the dedup).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline.operators import cleanse as C
from tierline.operators import quality as Q
from tierline.operators.dedup import dedup_latest
from tierline.operators.layout import compact, file_sizes, needs_compaction, worth_compacting, zorder
from tierline.operators.merge import upsert
from tierline.operators.partials import Store, apply_load
from tierline.operators.partials import current as current_result
from tierline.operators.partials import fold as fold_loads
from tierline.plans import increments as N
from tierline.plans import products as P
from tierline.session import checkpoint_root
from tierline.sinks.writers import align, save_mode, stored_schema, write_table
from tierline.sources import incremental as I
from tierline.sources.footers import footer_aggregates
from tierline.sources.readers import read_landing, read_table


def to_bronze(spark: SparkSession, source: str, dest: str, fmt: str = "csv",
              mode: str = "incremental", watermark_col: str | None = None,
              partition_by: Sequence[str] = (), glob: str = "*", schema=None,
              ingest_ts=None, optimize: bool = True, min_rows_to_optimize: int = 100_000,
              as_table: bool = False, overlap: bool = False, **read_opts) -> dict:
    """Load a landing area into the bronze table ``dest``: a Parquet path, or
    a catalog table name when ``as_table`` is set.

    The stored schema rules: columns it knows are read in its types (a column
    whose values its type cannot hold fails the load before anything is
    written), new columns join it.  With ``optimize``, the partitions the load
    has added files to (or an unpartitioned table) are compacted in place where
    small files make it worth it, once the table has more than
    ``min_rows_to_optimize`` rows, which is the reference's gate.

    An incremental load takes rows above the high-watermark; with ``overlap``
    also rows equal to it that are not loaded yet (``overlap_load``).

    Returns the run facts: watermark used, rows written, final row count,
    rows above the previous watermark, and files before / after compaction.
    """
    def current():
        if as_table:
            return spark.table(dest) if spark.catalog.tableExists(dest) else None
        return read_table(spark, dest) if stored_schema(spark, dest) is not None else None

    target = current()
    files = set(target.inputFiles()) if target is not None else set()
    incremental = mode == "incremental" and target is not None
    wm = I.high_watermark(target, watermark_col, stored=True) if incremental else None
    src = read_landing(spark, source, glob=glob, fmt=fmt, schema=schema, **read_opts)
    if incremental and schema is None:
        src = _in_stored_types(spark, src, target.schema, source, glob, fmt, read_opts)
    src = C.with_ingest_metadata(src, ts=ingest_ts)
    if overlap and wm is not None:
        src = I.overlap_load(src, target, watermark_col, wm, ignore=(C.INGEST_TS, C.SOURCE_FILE))
    else:
        src = I.incremental(src, watermark_col, wm, mode=mode)
    # Optimized write: rebalance on the partition columns so each directory
    # gets a few well-sized files instead of one file per task (AQE splits a
    # hot partition value over several tasks).
    stats = write_table(src, dest, mode=save_mode(mode), partition_by=partition_by,
                        rebalance=bool(partition_by), as_table=as_table, merge_schema=True)
    if as_table:
        spark.catalog.refreshTable(dest)
    final = current()
    facts = {"watermark": wm, "rows_written": stats["rows"]}
    total = footer_aggregates(final, {"rows": ("count", None)})["rows"]
    facts["final_rows"] = total
    if wm is not None:
        facts["new_rows"] = I.new_rows(final, watermark_col, wm).first()["new_records"]
    if optimize and needs_compaction(total, min_rows_to_optimize):
        added = set(current().inputFiles()) - files
        facts["files_before"], facts["files_after"] = _compact_in_place(spark, current, dest, list(partition_by), added, as_table)
    return facts


def _in_stored_types(spark, src: DataFrame, stored, source: str, glob: str, fmt: str, read_opts: dict) -> DataFrame:
    """The landing rows with the stored type for every known column.  Text is
    read again as text (an inferred number would lose leading zeros); other
    types must hold the inferred one."""
    known = {f.name: f.dataType for f in stored.fields}
    as_text = [f.name for f in src.schema.fields if isinstance(known.get(f.name), StringType) and not isinstance(f.dataType, StringType)]
    if as_text:
        files = [f for f in src.schema.fields]
        schema = StructType([StructField(f.name, StringType() if f.name in as_text else f.dataType) for f in files])
        src = read_landing(spark, source, glob=glob, fmt=fmt, schema=schema, **read_opts)
    here = StructType([f for f in stored.fields if f.name in src.columns])
    return align(src, here, new_columns=True)


def _compact_in_place(spark, current, dest: str, partition_by: list, added: set[str], as_table: bool) -> tuple[int, int]:
    """Rewrites the directories that the files ``added`` have made worth it
    (``worth_compacting``; an unpartitioned table is one directory) as few,
    well-sized files.  The old files stay until the new ones take their place
    (``tierline.sinks.replace``), so nothing is staged and a failed compaction
    leaves the table as it was.  Which partitions a load has touched is read off
    the names of its files, not from the source."""
    table = current()
    before = len(table.inputFiles())
    worth = [d for d in sorted({f.rpartition("/")[0] for f in added}) if worth_compacting(file_sizes(spark, d))]
    if not worth:
        return before, before
    if not partition_by:
        write_table(compact(table), dest, mode="overwrite", as_table=as_table)
    else:
        touched = _partition_values(spark, worth, partition_by, table.schema)
        on = [table[c].eqNullSafe(touched[c]) for c in partition_by]
        rows = table.join(touched, on, "left_semi").select(*table.columns).hint("rebalance", *partition_by)
        write_table(rows, dest, mode="overwrite", partition_by=partition_by, dynamic_overwrite=True, as_table=as_table)
    if as_table:
        spark.catalog.refreshTable(dest)
    return before, len(current().inputFiles())


def _partition_values(spark: SparkSession, directories: list[str], partition_by: list, schema: StructType) -> DataFrame:
    """The partition values that directory names (``.../a=1/b=x``) stand for."""
    rows = []
    for d in directories:
        pairs = [unquote(unquote(part)).partition("=") for part in d.split("/")[-len(partition_by):]]
        rows.append(tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else v for _, _, v in pairs))
    text = spark.createDataFrame(rows, StructType([StructField(c, StringType()) for c in partition_by]))
    return text.select(*[text[c].cast(schema[c].dataType).alias(c) for c in partition_by])


def to_silver(bronze: DataFrame, keys: Sequence[str] = (), order_by: Sequence[str] = (C.INGEST_TS,),
              ties: Sequence[str] = (), rules: Iterable[Q.Rule] | None = Q.DEFAULT_RULES,
              as_of=None, date_cols: Sequence[str] = (), dedup: bool = True,
              processed_ts=None) -> DataFrame:
    """The validated layer: trimmed strings, typed dates, a row-level
    ``_data_quality_issues`` flag, one (latest) row per key and a
    processing timestamp."""
    if dedup and not keys:
        raise ValueError("primary keys are required for deduplication")
    df = C.trim_strings(bronze)
    if date_cols:
        df = C.cast_dates(df, date_cols)
    df = Q.flag_issues(df, rules or [], as_of=as_of)
    if dedup:
        df = dedup_latest(df, keys, order_by, ties)
    return C.with_processed_ts(df, processed_ts)


def publish_silver(silver: DataFrame, dest: str, keys: Sequence[str], as_table: bool = False,
                   cluster: bool = True) -> dict:
    """Write the validated table (overwrite), clustered on the first two
    primary keys as the reference's silver step does; returns rows written."""
    out = zorder(silver, list(keys)[:2], materialize=True) if (cluster and keys) else silver
    return write_table(out, dest, mode="overwrite", as_table=as_table)


# The gold tables and the columns the reference clusters them on.
GOLD_TABLES = {
    "daily_sales_summary": ["date"],
    "product_performance": ["category", "product_id"],
    "category_performance": ["category"],
    "customer_purchase_patterns": ["spend_segment", "frequency_segment", "recency_segment"],
    "dim_product": ["category", "manufacturer"],
}


# The keys that rows of a gold table are matched by.
GOLD_KEYS = {
    "daily_sales_summary": ["date"],
    "product_performance": ["product_id"],
    "category_performance": ["category", "year", "month"],
    "customer_purchase_patterns": ["customer_id"],
    "dim_product": ["product_id"],
}


def to_gold(orders: DataFrame, products: DataFrame, dest_root: str, as_of=None,
            orders_hdr: DataFrame | None = None, cluster: bool = True,
            segments: dict | None = None, as_table: bool = False, mode: str = "overwrite",
            only: Iterable[str] = tuple(GOLD_TABLES), load_id: str | None = None, fold: bool = False,
            exact_distinct: bool = True) -> dict:
    """Build and write the five gold tables under ``dest_root`` (a folder, or
    with ``as_table`` a catalog schema: ``<dest_root>.<table>``); returns the
    rows written per table (counted on the write itself).

    ``mode="merge"`` (the reference's default) adds the orders of one load to
    the tables: days, products, categories and customers that earlier loads have
    rows of, too, get the totals, averages and distinct counts over all of them.
    The mergeable states lie beside the tables (``operators.partials``);
    ``load_id`` names the load, and running it again doubles nothing.  ``fold``
    merges the stored loads into their base afterwards.  ``dim_product`` is
    upserted by key.

    ``mode="replace_keys"`` upserts finished rows by ``GOLD_KEYS``, for orders
    that hold all rows of every key they have: rows of other keys stay.

    ``category_performance`` is partitioned by (year, month); every table is
    Z-ordered on the reference's columns when ``cluster`` is set.

    Building runs jobs at once: the orders are stored in the checkpoint
    folder, as four products read them, and ranks are computed.  ``only``
    names the tables to build.
    """
    if mode not in ("overwrite", "merge", "replace_keys"):
        raise ValueError(f"mode must be overwrite, merge or replace_keys, not {mode!r}")
    if mode == "merge" and not load_id:
        raise ValueError("a merge needs a load_id")
    seg = segments or {}
    spark = orders.sparkSession
    checkpoint_root(spark)
    orders = orders.checkpoint(eager=True)
    hdr = orders_hdr if orders_hdr is not None else orders
    build = {
        "daily_sales_summary": lambda: P.daily_sales(hdr, exact_distinct=exact_distinct),
        "product_performance": lambda: P.product_performance(orders, products),
        "category_performance": lambda: P.category_performance(orders, products, exact_distinct=exact_distinct),
        "customer_purchase_patterns": lambda: P.segment_customers(P.customer_patterns(orders, as_of=as_of, exact_distinct=exact_distinct), **seg),
        "dim_product": lambda: P.dim_product(products),
    }
    done = F.col("status") == P.COMPLETED
    parts_of = {
        "daily_sales_summary": lambda: (hdr.filter(done), N.daily_sales(exact_distinct)),
        "product_performance": lambda: (orders.filter(done), N.product_performance(products)),
        "category_performance": lambda: (orders.filter(done).join(products.select("product_id", "category"), "product_id", "left"),
                                         N.category_performance(exact_distinct)),
        "customer_purchase_patterns": lambda: (orders, N.customer_patterns(as_of, exact_distinct, seg)),
    }
    written = {}
    for name in only:
        parts = ["year", "month"] if name == "category_performance" else []
        dest = f"{dest_root}.{name}" if as_table else f"{dest_root.rstrip('/')}/{name}"
        if mode == "merge" and name in parts_of:
            rows, partial = parts_of[name]()
            store = Store(spark, dest if as_table else f"{dest}__states", as_table)
            apply_load(rows, partial, store, load_id)
            if fold:
                fold_loads(partial, store)
            df = current_result(partial, store)
        else:
            df = build[name]()
            if mode != "overwrite" and stored_schema(spark, dest, as_table=as_table) is not None:
                stored = spark.table(dest) if as_table else read_table(spark, dest)
                df = upsert(align(stored, df.schema, new_columns=True), df, GOLD_KEYS[name])
        out = zorder(df, GOLD_TABLES[name], partition_by=parts, materialize=True) if cluster else df
        written[name] = write_table(out, dest, mode="overwrite", partition_by=parts,
                                    as_table=as_table)["rows"]
    return written
