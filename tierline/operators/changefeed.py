"""A change feed between stored snapshots that skips what has not changed.

A snapshot is stored partitioned by key range, beside a digest per range: the
number of rows and order-free sums of two 64-bit hashes of every whole row.  Two
snapshots' digests are compared first (as many rows as ranges); ranges with equal
digests are not read, and only the others are diffed exactly.

Ranges are ``span`` consecutive values of the first key if that is an integer or
a date, so that changes to neighbouring keys stay together; other keys, and nulls,
are dealt to ``buckets`` by hash.  Both snapshots must use the same setting.

A changed range goes unnoticed only if its row count and both 64-bit sums agree
by chance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType, StructType

from tierline.functions.keys import row_hashes
from tierline.operators.merge import snapshot_diff
from tierline.sinks.writers import write_table
from tierline.sources.readers import read_table

RANGE = "_range"
_HALF = 1 << 32


def key_range(schema: StructType, keys: Sequence[str], span: int, buckets: int) -> Column:
    first, kind = F.col(keys[0]), schema[keys[0]].dataType
    dealt = -1 - F.pmod(F.xxhash64(*keys), F.lit(buckets))             # below every range of small keys
    if isinstance(kind, DateType):
        first = F.unix_date(first)
    elif not isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return dealt.cast("bigint")
    # Negative keys are dealt by hash too: their ranges would meet the buckets' numbers.
    return F.when(first >= 0, F.floor(first / F.lit(span))).otherwise(dealt).cast("bigint")


def range_digests(snapshot: DataFrame) -> DataFrame:
    """(range, n, a, b, c, d): rows and sums of both hashes' halves, which
    2^31 rows of a range cannot overflow."""
    schema = StructType([f for f in snapshot.schema.fields if f.name != RANGE])
    hashes = row_hashes(schema)
    halves = [x for h in hashes for x in (F.pmod(h, F.lit(_HALF)), F.shiftright(h, 32))]
    return snapshot.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(n) for n, x in zip("abcd", halves, strict=True)])


def store_snapshot(df: DataFrame, dest: str, keys: Sequence[str], span: int = 1 << 20, buckets: int = 256) -> None:
    """Writes ``df`` by key range, and the digests to ``<dest>__digest``."""
    ranged = df.withColumn(RANGE, key_range(df.schema, list(keys), span, buckets))
    write_table(ranged, dest, partition_by=[RANGE], rebalance=True, count_rows=False)
    spark = df.sparkSession
    write_table(range_digests(read_table(spark, dest)), f"{dest}__digest", count_rows=False)


def changed_ranges(spark: SparkSession, old: str, new: str) -> list[int]:
    """The ranges whose digests differ, or that one snapshot lacks."""
    a, b = (read_table(spark, f"{p}__digest") for p in (old, new))
    both = a.withColumn("side", F.lit(0)).unionByName(b.withColumn("side", F.lit(1)))
    facts = [c for c in a.columns if c != RANGE]
    per = both.groupBy(RANGE, *facts).agg(F.count(F.lit(1)).alias("sides")).filter("sides = 1")
    return sorted(r[0] for r in per.select(RANGE).distinct().collect())       # a number per range at most


def change_feed(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """Changes from the stored snapshot ``old`` to ``new``, as ``snapshot_diff``
    gives them; only the changed ranges are read."""
    ranges = changed_ranges(spark, old, new)
    sides = [read_table(spark, p) for p in (old, new)]
    return snapshot_diff(*[s.filter(F.col(RANGE).isin(ranges)).drop(RANGE) for s in sides], keys)
