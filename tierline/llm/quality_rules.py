"""Quality rules: robust multivariate outliers (minimum covariance determinant).

Every document gets counts over its whole text (``text_stats``).  A base rule
rejects the plainly bad: fewer than ``min_words`` words, or more than a fifth
of the words inside 5-word windows that occur twice or more.  The others are
judged per (language, source):

* the counts become a vector of five transformed statistics (``VECTOR``);
* per group, two deterministic MCD starts, both centred at the medians: the
  scaled median absolute deviation of each statistic, and the covariance of the
  spatial signs (rows shrunk to distance one, which keeps the directions in
  which statistics vary together).  Each takes ``steps`` concentration steps:
  keep the share ``h`` of the rows with the smallest Mahalanobis distance, refit
  mean and covariance on them.  The start that ends with the least determinant
  is taken.  No row is sampled, every step aggregates all rows;
* the covariance is widened, never narrowed, until the median squared distance
  is at most that of a chi-square with five degrees, and no statistic is taken
  to vary less than ``FLOOR`` (most documents have no symbols or repeats at all,
  where the estimate would be singular);
* a group with fewer than ``min_rows`` rows is judged by its language, and a
  language with fewer by the whole table;
* a row is rejected if its squared distance exceeds ``cutoff`` and it lies on
  the bad side (more symbols, repeats, repeated lines, or odd word lengths
  than the centre by over ``FLOOR``); a long or short document alone is none.
  ``cutoff`` is far above the 0.999 quantile of that chi-square (20.5), as
  symbols and repeats are no normal variables: their tails are long.

A step reads the vectors only (text is read once) and ends in one row per
group; 5 x 5 matrices are inverted where the group's row is.

Defined results: null text has no words (base rule fails, not kept); null
language or source form a group of their own; repeated rows are judged alike;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import stable

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SYMBOLS = "#*$%&|<>"
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: Statistic -> its least standard deviation.
FLOOR = {"z_words": 0.5, "z_len": 0.06, "z_sym": 0.25, "z_dup": 0.35, "z_rep": 0.05}
VECTOR = list(FLOOR)
CHI2_MEDIAN = 4.351      # of five degrees of freedom


def repeat_words(words: list[str], width: int = 5) -> int:
    """Words that lie in a ``width``-word window found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    if len(number) == len(words):
        return 0
    code = np.zeros(n, np.uint64)
    for i in range(width):
        code = (code ^ (code >> np.uint64(29))) * _MIX + ids[i:n + i]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _count(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = _WORDS.findall(text)
    lines = [ln for ln in text.split("\n") if _WORDS.search(ln)]
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


def text_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the counts of ``STATS``."""
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rest = [f for f in docs.schema.fields if f.name not in (text_col, *made)]
    names = [f.name for f in rest]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = pd.DataFrame([_count(t) for t in b[text_col]], dtype="int64",
                               columns=made)
            yield pd.concat([b[names].reset_index(drop=True), got], axis=1)

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), STATS])
    return docs.select(*names, text_col).mapInPandas(run, ddl)


def vector(df: DataFrame) -> DataFrame:
    """The transformed statistics; null where there is no word."""
    n = F.when(F.col("n_words") > 0, F.col("n_words").cast("double"))
    return df.withColumns({
        "z_words": F.log1p(n), "z_len": F.log(F.col("word_chars") / n),
        "z_sym": F.log1p(100 * F.col("n_symbols") / n), "z_dup": F.log1p(F.col("n_dup_lines").cast("double")),
        "z_rep": F.sqrt(F.col("n_repeat_words") / n)})


def _distance(prec: str, mean: str) -> Column:
    """Squared Mahalanobis distance, spelled out so that it compiles."""
    d = {v: F.col(v) - F.col(mean)[i] for i, v in enumerate(VECTOR)}
    p = len(VECTOR)
    return sum(F.col(prec)[i * p + j] * d[a] * d[b] for i, a in enumerate(VECTOR) for j, b in enumerate(VECTOR))


def _inverted(moments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, s_i, s_ij) -> (keys, mean, prec, logdet): 5 x 5 inverses, one row
    per group."""
    p, floor = len(VECTOR), np.square(list(FLOOR.values()))

    def run(batches):
        for b in batches:
            mean = b[[f"s{i}" for i in range(p)]].to_numpy(float) / b[["n"]].to_numpy(float)
            prec, logdet = [], []
            for row, m in zip(b.itertuples(index=False), mean, strict=True):
                c = np.array([[getattr(row, f"s{min(i, j)}_{max(i, j)}") for j in range(p)] for i in range(p)]) / row.n
                c = c - np.outer(m, m)
                c[np.diag_indices(p)] = np.maximum(np.diag(c), 0) + floor
                prec.append(np.linalg.inv(c).ravel().tolist())
                logdet.append(float(np.linalg.slogdet(c)[1]))
            yield pd.concat([b[keys].reset_index(drop=True), pd.DataFrame({"mean": mean.tolist(), "prec": prec, "logdet": logdet})], axis=1)

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in moments.schema.fields if f.name in keys),
                     "mean array<double>", "prec array<double>", "logdet double"])
    return moments.mapInPandas(run, ddl)


def _sums() -> list[Column]:
    p = len(VECTOR)
    return [F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(VECTOR)],
            *[F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]]


def _diagonal_start(centre: DataFrame, keys: list[str]) -> DataFrame:
    """Precision of independent statistics with the given scales."""
    p = len(VECTOR)
    prec = [F.pow(F.col("scale")[i], F.lit(-2)) if i == j else F.lit(0.0) for i in range(p) for j in range(p)]
    return centre.select(*keys, "mean", F.array(*prec).alias("prec"))


def _sign_start(near: DataFrame, keys: list[str]) -> DataFrame:
    """Precision from the rows' spatial signs: rows in units of the scales,
    divided by their length (rows at the centre count as nothing)."""
    p = len(VECTOR)
    z = [(F.col(v) - F.col("mean")[i]) / F.col("scale")[i] for i, v in enumerate(VECTOR)]
    length = F.sqrt(sum(x * x for x in z))
    unit = [F.when(length > 0, x / length).otherwise(F.lit(0.0)) for x in z]
    signs = near.select(*keys, "mean", "scale", *[u.alias(v) for u, v in zip(unit, VECTOR, strict=True)])
    sums = signs.groupBy(*keys).agg(F.first("mean").alias("mean"), F.first("scale").alias("scale"), *_sums())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            prec = []
            for row in b.itertuples(index=False):
                c = np.array([[getattr(row, f"s{min(i, j)}_{max(i, j)}") for j in range(p)] for i in range(p)]) / row.n * p
                c = c + 0.05 * np.eye(p)                   # no direction is without spread
                scale = np.array(row.scale)
                prec.append((np.linalg.inv(c) / np.outer(scale, scale)).ravel().tolist())
            yield pd.concat([b[[*keys, "mean"]].reset_index(drop=True), pd.DataFrame({"prec": prec})], axis=1)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in near.schema.fields if f.name in keys)
    return sums.mapInPandas(run, f"{kinds}, mean array<double>, prec array<double>")


def fit_mcd(rows: DataFrame, keys: list[str], h: float, steps: int) -> DataFrame:
    """(keys, n, mean, prec): the robust centre and precision of each group.
    Quantiles are ``percentile_approx`` (error 1/10,000 of a group's rows)."""
    p = len(VECTOR)
    start = rows.groupBy(*keys).agg(*[F.percentile_approx(v, 0.5, 10000).alias(v) for v in VECTOR])
    on = [F.col(k).eqNullSafe(F.col(f"m_{k}")) for k in keys]

    def beside(model: DataFrame) -> DataFrame:
        """Every row with the model of its group (of each start, before the choice)."""
        return rows.join(model.withColumnsRenamed({k: f"m_{k}" for k in keys}), on).drop(*[f"m_{k}" for k in keys])

    near = beside(start.withColumnsRenamed({v: f"c_{v}" for v in VECTOR}))
    mad = near.groupBy(*keys).agg(*[F.first(f"c_{v}").alias(f"c_{v}") for v in VECTOR],
                                  *[F.percentile_approx(F.abs(F.col(v) - F.col(f"c_{v}")), 0.5, 10000).alias(v) for v in VECTOR])
    scales = [F.sqrt(F.pow(1.4826 * F.col(v), F.lit(2)) + FLOOR[v] ** 2) for v in VECTOR]
    centre = stable(mad.select(*keys, F.array(*[F.col(f"c_{v}") for v in VECTOR]).alias("mean"), F.array(*scales).alias("scale")))
    models = [_diagonal_start(centre, keys), _sign_start(beside(centre), keys)]
    model = models[0].withColumn("start", F.lit(0)).unionByName(models[1].withColumn("start", F.lit(1)))
    each = [*keys, "start"]
    for _ in range(steps):
        model = stable(model.select(*each, "mean", "prec"))
        far = beside(model).withColumn("d", _distance("prec", "mean"))
        cut = far.groupBy(*each).agg(F.percentile_approx("d", h, 10000).alias("cut"))
        cut = cut.withColumnsRenamed({k: f"q_{k}" for k in each})
        inner = beside(model.join(cut, [F.col(k).eqNullSafe(F.col(f"q_{k}")) for k in each])
                       .select(*each, "mean", "prec", "cut")).filter(_distance("prec", "mean") <= F.col("cut"))
        model = _inverted(inner.groupBy(*each).agg(*_sums()), each)
    least = F.min_by(F.struct("mean", "prec"), F.struct("logdet", "start")).alias("m")
    model = model.groupBy(*keys).agg(least).select(*keys, "m.mean", "m.prec")
    model = stable(model)
    # Consistency: the middle row of a group lies where a normal one would.
    scale = (beside(model).withColumn("d", _distance("prec", "mean")).groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("d", 0.5, 10000).alias("mid")))
    return (model.join(scale, [model[k].eqNullSafe(scale[k]) for k in keys])
            .select(*[model[k] for k in keys], "n", "mean", F.expr(
                f"transform(prec, x -> x / greatest(mid / {CHI2_MEDIAN}, 1.0D))").alias("prec")))


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  groups: tuple[str, str] = ("lang", "source"), min_words: int = 10, h: float = 0.75,
                  steps: int = 3, min_rows: int = 50, cutoff: float = 120.0) -> DataFrame:
    """One row per document: id, the counts, ``base_failed``, ``distance``
    (squared, null if the base rule failed) and ``kept``."""
    lang, source = groups
    stats = text_stats(docs.select(F.col(id_col), F.col(lang).alias("g_lang"), F.col(source).alias("g_source"),
                                   F.col(text_col)), text_col)
    bad = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = stable(vector(stats).withColumn("base_failed", bad))
    none = F.lit(None).cast("string")
    # Each row counts for its group, its language and the whole, in one fit.
    sound = (rows.filter(~F.col("base_failed")).select(
        *VECTOR, F.explode(F.array(
            F.struct(F.lit(0).alias("level"), F.col("g_lang").cast("string").alias("l"), F.col("g_source").cast("string").alias("s")),
            F.struct(F.lit(1).alias("level"), F.col("g_lang").cast("string").alias("l"), none.alias("s")),
            F.struct(F.lit(2).alias("level"), none.alias("l"), none.alias("s")))).alias("g"))
        .select(*VECTOR, "g.*"))
    model = stable(fit_mcd(sound, ["level", "l", "s"], h, steps)
                   .filter((F.col("n") >= min_rows) | (F.col("level") == 2)))
    out = rows
    for level, on in enumerate(({"l": "g_lang", "s": "g_source"}, {"l": "g_lang"})):
        m = (model.filter(F.col("level") == level)
             .select(F.col("l").alias("m_l"), F.col("s").alias("m_s"), F.col("mean").alias(f"mean{level}"),
                     F.col("prec").alias(f"prec{level}")))
        out = out.join(m, [F.col(f"m_{k}").eqNullSafe(F.col(v).cast("string")) for k, v in on.items()], "left").drop("m_l", "m_s")
    whole = model.filter(F.col("level") == 2).first()                    # one row of 30 numbers
    for c in ("mean", "prec"):
        out = out.withColumn(f"{c}2", F.lit(whole[c]) if whole else F.lit(None).cast("array<double>"))
    out = (out.withColumn("mean", F.coalesce("mean0", "mean1", "mean2"))
           .withColumn("prec", F.coalesce("prec0", "prec1", "prec2")))
    worse = F.abs(F.col("z_len") - F.col("mean")[VECTOR.index("z_len")]) > FLOOR["z_len"]
    for v in ("z_sym", "z_dup", "z_rep"):
        worse = worse | (F.col(v) - F.col("mean")[VECTOR.index(v)] > FLOOR[v])
    out = out.withColumn("distance", F.when(~F.col("base_failed"), _distance("prec", "mean")))
    rejected = F.coalesce((F.col("distance") > cutoff) & worse, F.lit(False))
    return out.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "distance", (~F.col("base_failed") & ~rejected).alias("kept"))
