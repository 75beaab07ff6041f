"""Counts, least and greatest values of a Parquet table from its file footers.

Spark answers an aggregate without grouping from the footers alone if the table
is read by the DSv2 Parquet reader with ``spark.sql.parquet.aggregatePushdown``;
both settings are made in a session of their own, so that no other query of the
caller's session changes.  No row group is read: the cost grows with the number
of files, not of rows.

Spark finds a column's statistics by its position in the table's schema.  So the
files must hold the columns in the table's order, as ``write_table`` keeps them:
an append brings them into the stored order, new ones last.  A table whose first
file does not begin with its columns in that order (a projection, say) is not
asked this way.

Fall-back, to a plain aggregate over just the columns asked for: in that case; if
a type has no exact statistics (timestamps, strings, decimals, nested columns); if
a column is a partition column; or if the footers fail to answer, as where a file
has only nulls or a NaN in a column, or was written before the column existed.
"""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StructType)

WITH_STATISTICS = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DateType)

#: name -> ("min" | "max", column), or ("count", None) for the rows.
Aggregates = Mapping[str, tuple[str, str | None]]


def _columns(aggs: Aggregates) -> list[Column]:
    made = {"min": F.min, "max": F.max}
    return [(F.count(F.lit(1)) if kind == "count" else made[kind](c)).alias(n) for n, (kind, c) in aggs.items()]


def pushed_aggregates(table: DataFrame, aggs: Aggregates) -> DataFrame | None:
    """The one-row aggregate over the files of ``table`` (a plain scan of
    Parquet files) as the footers answer it; None where types forbid it."""
    spark = table.sparkSession
    directories = sorted({f.rpartition("/")[0] for f in table.inputFiles()})
    # Partition columns are not in the files.
    inside = [f for f in table.schema.fields if not any(f"/{f.name}=" in d for d in directories)]
    kinds = {f.name: f.dataType for f in inside}
    if not directories or any(kind != "count" and not isinstance(kinds.get(c), WITH_STATISTICS) for kind, c in aggs.values()):
        return None
    file = spark.read.parquet(min(table.inputFiles())).schema.names
    if file != [f.name for f in inside][:len(file)]:
        return None
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(StructType(inside)).parquet(*directories).agg(*_columns(aggs))


def footer_aggregates(table: DataFrame, aggs: Aggregates) -> dict:
    """The aggregates of ``table`` by name, from its footers where they can tell."""
    pushed = pushed_aggregates(table, aggs)
    if pushed is not None:
        try:
            got = pushed.first().asDict()
            # Spark adds up the files' counts, and no files add up to null.
            return {n: 0 if kind == "count" and got[n] is None else got[n] for n, (kind, _) in aggs.items()}
        except (Py4JJavaError, PySparkException):
            pass                # the scan below answers, or fails for a reason of its own
    return table.agg(*_columns(aggs)).first().asDict()
