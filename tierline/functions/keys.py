"""One text per key, for joins that must be null-safe and keep a bucketing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def key_text(cols: Sequence[Column]) -> Column:
    """The columns as one string that is never null: equal exactly where all of
    them are equal, nulls included (null parts are left out of the JSON)."""
    return F.to_json(F.struct(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(cols)]))


def row_text(schema: StructType) -> Column:
    """A whole row as one string; nested columns as JSON."""
    return key_text([F.to_json(F.col(f"`{f.name}`")) if _nested(f.dataType) else F.col(f"`{f.name}`") for f in schema.fields])


def row_hashes(schema: StructType, seeds: Sequence[int] = (1, 2)) -> list[Column]:
    """64-bit hashes of a whole row, one per seed, in which a null differs from
    a value elsewhere (XXH64 itself passes over nulls)."""
    cols = [F.to_json(F.col(f"`{f.name}`")) if _nested(f.dataType) else F.col(f"`{f.name}`") for f in sorted(schema.fields, key=lambda f: f.name)]
    nulls = F.concat(*[F.when(c.isNull(), "n").otherwise("v") for c in cols])
    return [F.xxhash64(F.lit(s), nulls, *cols) for s in seeds]


def _nested(dtype: DataType) -> bool:
    return isinstance(dtype, (ArrayType, MapType, StructType, VariantType))
