"""Predicates used by the data-quality rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

# The rule patterns must equal the reference's rules.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^\+?[0-9]{10,15}$"


def matches_fully(c, pattern: str) -> Column:
    """True when the value matches ``pattern``; null stays null (so it never
    counts as a violation: ``NOT null`` is null, and a null filter keeps nothing)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.rlike(pattern)


def as_date(c, dtype=None) -> Column:
    """A date view of a column of any type: dates pass through, timestamps
    are truncated, text goes through ``try_to_date`` so bad text is null
    rather than a task failure under ANSI mode."""
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, DateType):
        return col
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(col)
    return F.try_to_date(col.cast("string"))
