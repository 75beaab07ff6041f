"""Row-level data-quality rules, issue summaries and column profiles.

A rule is a ``Column`` predicate that is true when a value violates it.
Flags and counts are computed inside one projection / one aggregate, so
quality checks never add extra passes over the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StructType
from pyspark.sql.window import Window

from tierline.functions.money import finite
from tierline.functions.rules import EMAIL_PATTERN, PHONE_PATTERN, as_date, matches_fully
from tierline.session import checkpoint_root

ISSUES = "_data_quality_issues"
DATE_COLUMNS = "date_columns"   # a rule target meaning "every date-like column"


@dataclass(frozen=True)
class Rule:
    """``violates(column, dtype, as_of)`` returns a Column that is true for a
    bad value.  ``column`` is a column name or ``DATE_COLUMNS``."""
    column: str
    name: str
    violates: Callable[[str, object, Column], Column]
    message: str


def _email(c, dtype, as_of):
    return ~matches_fully(c, EMAIL_PATTERN)


def _phone(c, dtype, as_of):
    return ~matches_fully(c, PHONE_PATTERN)


def _future(c, dtype, as_of):
    return as_date(c, dtype) > as_of


# The reference's rule set (rule names and messages).
DEFAULT_RULES = (
    Rule("email", "valid_format", _email, "Invalid email format"),
    Rule("phone", "valid_format", _phone, "Invalid phone number format"),
    Rule(DATE_COLUMNS, "future_date", _future, "Date is in the future"),
)


def email_rule(column: str = "email") -> Rule:
    return Rule(column, "valid_format", _email, "Invalid email format")


def phone_rule(column: str = "phone") -> Rule:
    return Rule(column, "valid_format", _phone, "Invalid phone number format")


def future_date_rule(column: str = DATE_COLUMNS) -> Rule:
    return Rule(column, "future_date", _future, "Date is in the future")


def date_columns(schema: StructType) -> list[str]:
    """Columns the date rules apply to: DATE columns and names ending ``_date``."""
    return [f.name for f in schema.fields
            if isinstance(f.dataType, DateType) or f.name.lower().endswith("_date")]


def _as_of_col(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def resolve(df: DataFrame, rules: Iterable[Rule] = DEFAULT_RULES, as_of=None):
    """(column, rule, violation predicate, message) for every rule whose
    column exists in ``df``, with date rules expanded over the date columns."""
    types = {f.name: f.dataType for f in df.schema.fields}
    when = _as_of_col(as_of)
    out = []
    for r in rules:
        targets = date_columns(df.schema) if r.column == DATE_COLUMNS else (
            [r.column] if r.column in types else [])
        for c in targets:
            out.append((c, r.name, r.violates(c, types[c], when), r.message))
    return out


def flag_issues(df: DataFrame, rules: Iterable[Rule] = DEFAULT_RULES, as_of=None) -> DataFrame:
    """Add ``_data_quality_issues``: the violated ``column:rule`` tags of the
    row joined by ", " ('' for a clean row).  Null values violate nothing."""
    checks = resolve(df, rules, as_of)
    tags = [F.when(pred, F.lit(f"{c}:{name}")) for c, name, pred, _ in checks]
    flag = F.concat_ws(", ", *tags) if tags else F.lit("")
    return df.withColumn(ISSUES, flag)


def issue_summary(df: DataFrame, rules: Iterable[Rule] = DEFAULT_RULES, as_of=None) -> DataFrame:
    """(column, rule, invalid_count, message) for each rule with at least
    one violation, from a single aggregate over the data."""
    checks = resolve(df, rules, as_of)
    if not checks:
        return df.sparkSession.createDataFrame(
            [], "column string, rule string, invalid_count bigint, message string")
    counts = df.agg(*[F.count_if(pred).alias(f"n{i}") for i, (_, _, pred, _) in enumerate(checks)])
    parts = []
    for i, (c, name, _, msg) in enumerate(checks):
        parts.append(F.struct(F.lit(c).alias("column"), F.lit(name).alias("rule"),
                              F.col(f"n{i}").alias("invalid_count"), F.lit(msg).alias("message")))
    return (counts.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
            .filter(F.col("invalid_count") > 0))


# Profile statistics in the order the reference's summary shows them.
PROFILE_STATS = ("count", "mean", "stddev", "min", "p25", "p50", "p75", "max")
PERCENTILES = (0.25, 0.5, 0.75)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(i, q0, q1, ...): for column number ``i`` the smallest value whose rank
    reaches ``p * count``, exact at any size.  Equal values are counted first
    (map-side); the distinct ones are range-partitioned, and running totals
    inside each range are offset by a table of one row per range and column."""
    x = [F.struct(F.lit(i).alias("i"), finite(F.col(c).cast("double")).alias("x")) for i, c in enumerate(cols)]
    counts = (df.select(F.explode(F.array(*x)).alias("v")).select("v.*").filter(F.col("x").isNotNull())
              .groupBy("i", "x").agg(F.count(F.lit(1)).alias("n")))
    checkpoint_root(df.sparkSession)
    ranged = (counts.repartitionByRange("i", "x").withColumn("part", F.spark_partition_id())
              .checkpoint(eager=True))
    sizes = ranged.groupBy("i", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("i").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("i", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                           F.sum("n").over(Window.partitionBy("i")).alias("total"))
    local = Window.partitionBy("i", "part").orderBy("x")
    ranks = (ranged.withColumn("upto", F.sum("n").over(local)).join(offsets, ["i", "part"])
             .withColumn("upto", F.col("upto") + F.col("before")))
    return ranks.groupBy("i").agg(*[F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * F.col("total")), F.col("x"))).alias(f"q{k}")
                                    for k, p in enumerate(probs)])


def profile(df: DataFrame, cols: Sequence[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """Column profile, one row per numeric column: count, mean, stddev
    (sample), min, 25/50/75 % and max.

    Percentiles are exact: the smallest value whose rank reaches
    ``p * count`` (``exact_quantiles``).  With ``accuracy`` they are
    ``percentile_approx`` sketches of that accuracy instead, from the same
    aggregate as the rest (one pass, for a quick look).  The mean is an exact
    decimal sum over the count (independent of row order); stddev is rounded
    to 4 places.  NaN and infinite values count as missing.
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    aggs = []
    for i, c in enumerate(cols):
        x = finite(F.col(c).cast("double"))
        aggs += [F.count(x).alias(f"c{i}"), F.try_divide(F.sum(x.cast("decimal(38,9)")).cast("double"),
                                                      F.count(x).cast("double")).alias(f"a{i}"),
                 F.round(F.stddev_samp(x), 4).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        if accuracy:
            aggs.append(F.percentile_approx(x, list(PERCENTILES), accuracy).alias(f"p{i}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.col(f"c{i}").alias("count"),
                     F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                     F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
                     *([F.col(f"p{i}")[k].alias(f"q{k}") for k in range(3)] if accuracy else []))
            for i, c in enumerate(cols)]
    out = one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    if not accuracy:
        out = out.join(exact_quantiles(df, cols, PERCENTILES), "i", "left")
    return out.select("column", "count", "mean", "stddev", "min", F.col("q0").alias("p25"),
                      F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")


# The bound on the rank error of a KLL sketch by its size k: with 99 % confidence
# a quantile's rank is off by at most this share of the rows (k 200: 1.33 %).
def kll_rank_bound(k: int) -> float:
    return 2.296 / k ** 0.9723


def profile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = 200) -> DataFrame:
    """One KLL sketch per column (binary, some kB whatever the rows), per group
    of ``by``, say a table's partitions: profiles that add up.  NaN and infinite
    values count as missing."""
    made = [F.kll_sketch_agg_double(finite(F.col(c).cast("double")), k).alias(c) for c in cols]
    return df.groupBy(*by).agg(*made)


def merge_sketches(sketches: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The sketches of any number of groups as one per group of ``by``."""
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c).alias(c) for c in cols])


def sketch_profile(sketches: DataFrame, cols: Sequence[str], probs: Sequence[float] = PERCENTILES, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, count, q0, q1, ...): the quantiles that sketches tell;
    null where a column has no value."""
    n = lambda c: F.kll_sketch_get_n_double(c)
    rows = [F.struct(F.lit(c).alias("column"), n(c).alias("count"),
                     *[F.when(n(c) > 0, F.kll_sketch_get_quantile_double(F.col(c), F.lit(p))).alias(f"q{i}") for i, p in enumerate(probs)])
            for c in cols]
    return sketches.select(*by, F.explode(F.array(*rows)).alias("s")).select(*by, "s.*")
