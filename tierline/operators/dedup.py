"""Latest row per key (the silver-layer deduplication).

``row_number() = 1`` over the key.  Spark limits each group before the
shuffle as well (``WindowGroupLimit``): every task ships at most one candidate
per key, so a key with a third of the rows is no large task.

Ties: the order is extended with the whole row, so among rows with equal
order columns the result is still one fixed row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType
from pyspark.sql.window import Window

_RANK = "__latest"


def orderable(dtype) -> bool:
    """Whether values of the type can be sorted."""
    if isinstance(dtype, (MapType, VariantType)):
        return False
    if isinstance(dtype, StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return orderable(dtype.elementType)
    return True


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 ties: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``keys``: the one with the greatest ``order_by``
    tuple (compared left to right, like ``ORDER BY c1 DESC, c2 DESC``; nulls
    lose), then the greatest ``ties`` tuple, then the greatest remaining
    columns (those that can be ordered).

    Null keys form one group, as in ``Window.partitionBy``.
    """
    if not keys:
        raise ValueError("dedup_latest needs at least one key column")
    if not order_by:
        raise ValueError("dedup_latest needs an order column")
    first = [*order_by, *ties]
    rest = [f.name for f in df.schema.fields if f.name not in {*first, *keys} and orderable(f.dataType)]
    w = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in [*first, *rest]])
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)
