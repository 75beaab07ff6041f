"""Table layout: Z-order clustering, compaction, table detail.

Plain Spark has no OPTIMIZE / ZORDER; the same effect comes from writing the
data in a clustered order, so Parquet min/max statistics of each file and
row group cover a narrow box of the clustered columns and selective filters
skip most of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, MapType, NumericType, StringType, TimestampNTZType,
                               TimestampType, VariantType)
from pyspark.sql.window import Window

from tierline.functions.zorder import interleave_bits
from tierline.operators.rank import rank_pairs
from tierline.session import checkpoint_root

ZCOL = "__z"


def _numeric_surrogate(c: str, dtype) -> Column:
    col = F.col(c)
    if isinstance(dtype, DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dtype, TimestampNTZType):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    if isinstance(dtype, TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(dtype, BooleanType):
        return col.cast("int").cast("double")
    return col.cast("double")


# Rows of the layout sample (boundaries only; no row is dropped by it).
SAMPLE_ROWS = 200_000


def _sample(df: DataFrame, specs: Sequence[tuple[str, object, str]]):
    """About ``SAMPLE_ROWS`` rows of the numeric surrogates, on the driver."""
    total = df.count()                       # file footers, for a table scan
    surs = df.select(*[F.coalesce(_numeric_surrogate(c, dt), F.lit(float("-inf"))).alias(out) for c, dt, out in specs])
    if total > SAMPLE_ROWS:
        surs = surs.sample(fraction=SAMPLE_ROWS / total, seed=17)
    return surs.toPandas()


def _bounds(values: np.ndarray, n: int) -> list[float]:
    """At most ``n - 1`` boundaries that cut the values into equal parts."""
    values = np.sort(values[np.isfinite(values)])
    if not len(values):
        return []
    at = (np.arange(1, n) * len(values)) // n
    return sorted({float(x) for x in values[at]})


def _bucketed(df: DataFrame, col: str, out: str, bounds: list[float]) -> DataFrame:
    """``out``: the number of boundaries at or below ``col``."""
    if not bounds:
        return df.withColumn(out, F.lit(0).cast("long"))
    b = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol=col, outputCol=out, handleInvalid="keep")
    return b.transform(df).withColumn(out, F.col(out).cast("long"))


def _rank_buckets(df: DataFrame, c: str, bits: int, out: str) -> DataFrame:
    """Equal-width bucket over the exact rank of the distinct values of a
    string column: the ranks are computed over the distinct values,
    range-partitioned, and joined back on the value (AQE splits a hot value)."""
    n = 1 << bits
    vals = df.select(F.col(c).alias("__v")).distinct()
    ranked = rank_pairs(vals, [], "__v", "__r", descending=False)
    total = ranked.agg(F.max("__r")).first()[0] or 1
    table = ranked.select("__v", F.floor((F.col("__r") - 1) * F.lit(n) / F.lit(total))
                          .cast("long").alias(out))
    return df.join(table, df[c].eqNullSafe(table["__v"]), "left").drop("__v")


def zorder(df: DataFrame, cols: Sequence[str], bits: int | None = None,
           num_partitions: int | None = None, partition_by: Sequence[str] = (),
           materialize: bool = False, target_file_mb: int = 128) -> DataFrame:
    """Rows of ``df`` range-partitioned and sorted by the Z-order key of
    ``cols`` (1-3 columns); write the result to get clustered files.

    Boundaries of numeric, date and boolean columns come from a sample of
    ``SAMPLE_ROWS`` rows; string columns use the exact rank of their distinct
    values.  A hash of the row breaks ties, so that a Z-value with a large
    share of the rows spreads over several files and a recomputed task deals
    its rows as before.  Without strings and ``partition_by`` the ranges come
    from the same sample and the input is read twice in all; otherwise Spark
    samples the range key itself.

    ``num_partitions`` follows the input's file sizes (one per
    ``target_file_mb``, at least the session's shuffle partitions).  With
    ``partition_by`` (the table's directory partitions) the range key starts
    with those columns, so each task writes into few directories and rows are
    Z-ordered inside each directory.  ``materialize`` checkpoints the input
    first, which pays off when it is an aggregate or join rather than a scan.
    """
    cols = list(cols)
    if not 1 <= len(cols) <= 3:
        raise ValueError("zorder takes one to three columns")
    n = num_partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                              math.ceil(input_bytes(df) / (target_file_mb << 20)))
    if materialize:
        checkpoint_root(df.sparkSession)
        df = df.checkpoint(eager=True)
    bits = bits or min(10, 63 // len(cols))
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric, strings, names = [], [], []
    for j, c in enumerate(cols):
        name = f"__zb{j}"
        dt = types[c]
        if isinstance(dt, (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)):
            numeric.append((c, dt, name))
        elif isinstance(dt, StringType):
            strings.append((c, name))
        else:
            raise TypeError(f"cannot Z-order on {c} of type {dt.simpleString()}")
        names.append(name)
    out, sample, drop = df, _sample(df, numeric) if numeric else None, list(names)
    for c, dt, name in numeric:
        bounds = _bounds(sample[name].to_numpy(float), 1 << bits)
        # A column of few values takes the high bits, else the others would go first.
        up = bits - len(bounds).bit_length()
        out = out.withColumn(f"__s{name}", F.coalesce(_numeric_surrogate(c, dt), F.lit(float("-inf"))))
        out = _bucketed(out, f"__s{name}", name, bounds).withColumn(name, F.shiftleft(name, up))
        sample[name] = np.searchsorted(bounds, sample[name].to_numpy(float), side="right") << up
        drop.append(f"__s{name}")
    for c, name in strings:
        out = _rank_buckets(out, c, bits, name)
    # Rows of one Z-value in 2^20 classes: Z plus a fraction, exact as a double.
    tie = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if _hashable(types[c])]), F.lit(1 << 20))
    out = out.withColumn(ZCOL, interleave_bits([F.col(x) for x in names], bits))
    parts = list(partition_by)
    if strings or parts or bits * len(cols) > 30:
        return (out.withColumn("__zt", tie).repartitionByRange(n, *parts, ZCOL, "__zt")
                .sortWithinPartitions(*parts, ZCOL).select(*df.columns))
    z = np.zeros(len(sample), np.int64)
    for j, name in enumerate(names):
        v = sample[name].to_numpy(np.int64)
        for k in range(bits):
            z |= (v >> k & 1) << (k * len(names) + len(names) - 1 - j)
    bounds = _bounds(z + np.random.default_rng(17).random(len(z)), n)
    out = out.withColumn("__zk", F.col(ZCOL).cast("double") + tie / F.lit(float(1 << 20)))
    out = _bucketed(out, "__zk", "__zp", bounds)
    return (out.repartitionById(n, F.col("__zp").cast("int")).sortWithinPartitions(ZCOL).select(*df.columns))


def _hashable(dtype) -> bool:
    return not isinstance(dtype, (MapType, VariantType))


def table_detail(df: DataFrame) -> DataFrame:
    """File-level facts of a file-source DataFrame, like DESCRIBE DETAIL:
    number of files, partition directories, bytes, rows and columns, from the
    hidden ``_metadata`` column (no data columns are read)."""
    per_file = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
        F.max("file_size").alias("size"), F.count(F.lit(1)).alias("rows"))
    directory = F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1)
    return per_file.agg(F.count(F.lit(1)).alias("num_files"),
                        F.count_distinct(directory).alias("num_directories"),
                        F.sum("size").alias("size_in_bytes"),
                        F.sum("rows").alias("num_rows")).withColumn(
        "num_columns", F.lit(len(df.columns)))


def file_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(file, column, lo, hi): least and greatest value per file and column of
    a file-source DataFrame, as numbers; a file without values has no row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    x = [_numeric_surrogate(c, types[c]) for c in cols]
    per = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[F.min(v).alias(f"lo{i}") for i, v in enumerate(x)], *[F.max(v).alias(f"hi{i}") for i, v in enumerate(x)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi")) for i, c in enumerate(cols)]
    return per.select("file", F.explode(F.array(*rows)).alias("r")).select("file", "r.*").filter(F.col("lo").isNotNull())


def overlap_depth(ranges: DataFrame) -> DataFrame:
    """(column, files, mean_depth, max_depth): how many files' ranges overlap a
    file's own, itself included, on average, and the most files that share one
    value.  1 is a table sorted by the column; ``files`` one that prunes nothing.

    A sweep over the ends of the ranges: two rows per file, not per row of the
    table, are sorted in one task per column."""
    ends = ranges.select("column", F.explode(F.array(F.struct(F.col("lo").alias("x"), F.lit(0).alias("end")),
                                                     F.struct(F.col("hi").alias("x"), F.lit(1).alias("end")))).alias("e")).select("column", "e.*")
    # Ranges that touch overlap: at one value the lower ends come first.
    upto = Window.partitionBy("column").orderBy("x", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = ends.withColumns({"opened": F.sum(1 - F.col("end")).over(upto), "closed": F.sum("end").over(upto)})
    # A file overlaps all that opened up to its end, but those that closed before it opened.
    return swept.groupBy("column").agg(
        F.sum("end").alias("files"),
        ((F.sum(F.when(F.col("end") == 1, F.col("opened"))) - F.sum(F.when(F.col("end") == 0, F.col("closed")))) / F.sum("end")).alias("mean_depth"),
        F.max(F.col("opened") - F.col("closed") + F.col("end")).alias("max_depth"))


def input_bytes(df: DataFrame) -> int:
    """Total bytes of the files behind a DataFrame (0 without files), from
    their listing."""
    spark = df.sparkSession
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    total = 0
    for f in df.inputFiles():
        p = path(f)
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return int(total)


def file_sizes(spark: SparkSession, directory: str) -> list[int]:
    """Bytes of the data files in one directory, from its listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    p = path(spark._jvm.java.net.URI(directory)) if ":" in directory.split("/")[0] else path(directory)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return [int(s.getLen()) for s in found if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def worth_compacting(sizes: Sequence[int], target_file_mb: int = 128) -> bool:
    """Whether a directory should be rewritten: two or more files are under
    half the target size and hold a quarter of the bytes.  So a row is
    rewritten about four times at most while its table grows, and a large table
    is left alone by a small load."""
    small = [s for s in sizes if s < target_file_mb << 19]
    return len(small) > 1 and 4 * sum(small) >= sum(sizes)


def needs_compaction(n_rows: int, min_rows: int = 100_000) -> bool:
    """The bronze gate: compact only tables above ``min_rows`` rows."""
    return n_rows > min_rows


def compact(df: DataFrame, target_file_mb: int = 128, size_bytes: int | None = None) -> DataFrame:
    """``df`` rearranged into at most ``size / target_file_mb`` partitions,
    i.e. that many files when written.  ``coalesce`` needs no shuffle: each
    task reads a run of the (already packed) input splits."""
    size = input_bytes(df) if size_bytes is None else size_bytes
    n = max(1, math.ceil(size / (target_file_mb * 1024 * 1024)))
    return df.coalesce(n)
