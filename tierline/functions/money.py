"""Money arithmetic.

Money columns arrive as doubles.  Summing raw doubles gives results that
depend on the order rows meet in a task, so two engines (or two runs with a
different partitioning) disagree in the last bits.  Every money sum is taken
over whole cents instead: each value is rounded half up to two places as a
decimal number (0.285 is 0.29, as in a cast to ``DECIMAL(18,2)``), taken in
cents as a BIGINT, the BIGINTs are summed exactly (and order independently),
and the total is handed back as a double.  This equals summing the values as
``DECIMAL(18,2)``, but the aggregation buffer is a fixed-width long, so it
stays on Spark's fast hash-aggregate path.  Totals are exact up to 9e13 in
money units (2^53 cents); beyond the BIGINT range the sum fails under ANSI
mode rather than wrapping.

Metrics are no money: ``exact_sum`` keeps ``places`` decimal places (nine) of each value.

NaN and infinite values count as missing, in sums and in averages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """A money value as an exact two-place decimal."""
    return _col(c).cast(MONEY)


def finite(c) -> Column:
    """The value, or null for NaN and infinity."""
    x = _col(c)
    return F.when(F.abs(x.cast("double")) < F.lit(float("inf")), x)


def cents(c) -> Column:
    """A money value in whole cents (BIGINT), rounded half up; null if not finite."""
    return F.rint(F.round(finite(c), 2) * 100).cast("long")


# Decimal places of a metric value that sums keep unless told otherwise.
METRIC_PLACES = 9


def metric_type(places: int = METRIC_PLACES) -> str:
    """The type that metric values are summed in: 28 digits up to nine places,
    30 digits beyond, so that ten digits more hold the sum of 10^10 rows."""
    if not 0 <= places <= 24:
        raise ValueError("places must be from 0 to 24")
    return f"decimal({28 if places <= 9 else 30},{places})"


def exact_sum(c, places: int = METRIC_PLACES) -> Column:
    """Exact, order-independent sum of a metric column, as a double.  Each value
    is rounded to ``places``: choose them by the metric's unit, as values below
    half of the last place count as 0."""
    return F.sum(finite(c).cast(metric_type(places))).cast("double")


def exact_mean(c, places: int = METRIC_PLACES) -> Column:
    """The exact sum divided by the count of finite values."""
    return safe_ratio(exact_sum(c, places), F.count(finite(c)).cast("double"))


def money_sum(c) -> Column:
    """Exact sum of a money column, as a double."""
    return F.sum(cents(c)).cast("double") / F.lit(100.0)


def mean_of_money(c) -> Column:
    """Average of a money column: the exact sum divided by the non-null count."""
    return safe_ratio(money_sum(c), F.count(finite(c)).cast("double"))


def safe_ratio(num, den) -> Column:
    """``num / den`` as a double; null instead of an error when ``den`` is 0 or null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def as_int(c) -> Column:
    """Narrow calendar parts and ranks to INT so every engine agrees on width."""
    return _col(c).cast("int")
