"""Embedding vectors on an integer grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grid_vectors(df: DataFrame, vec_col: str, scale: int, out: str) -> DataFrame:
    """The rows with a whole vector, and ``out``: array<bigint>, each entry c
    as ``floor(scale * c)`` in double precision (beyond the range of a long:
    the end of that range).  Rows whose vector is null or empty, or holds a
    null, NaN or infinite entry, go."""
    c = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    whole = F.forall(c, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    return (df.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & whole)
            .withColumn(out, F.transform(c, lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column without nulls as rows x entries (int64).  Vectors of
    different lengths are an error."""
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    d = width if width is not None else (len(flat) // rows if rows else 0)
    if rows and (pc.list_value_length(column).to_numpy(zero_copy_only=False) != d).any():
        raise ValueError("vectors of different lengths")
    return flat.reshape(rows, d)
