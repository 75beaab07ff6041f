"""Bit interleaving for Z-order keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def interleave_bits(buckets: Sequence[Column], bits: int) -> Column:
    """Morton code of ``len(buckets)`` integer columns, each holding
    ``bits`` significant bits: bit ``i`` of column ``j`` lands at position
    ``i * k + (k - 1 - j)``, so the first column is the most significant at
    every level.  Pure integer expressions, so it compiles into the stage."""
    k = len(buckets)
    if k == 0:
        raise ValueError("need at least one column")
    if bits * k > 63:
        raise ValueError(f"{k} columns x {bits} bits do not fit in 63 bits")
    z = F.lit(0).cast("long")
    for i in range(bits):
        for j, b in enumerate(buckets):
            bit = F.shiftright(b.cast("long"), i).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, i * k + (k - 1 - j)))
    return z
