"""Embedding whitening by shifted CholeskyQR.

The fit list is every distinct vector once, on the integer grid
``floor(scale * c)``; A is its n x d matrix of centred rows.  Nothing of A but
d x d sums ever leaves the tasks:

1. a pass over the rows gives the Gram matrix G of Q (at first A itself); each
   task adds up its own rows, the sums are added by a shuffle keyed by cell;
2. G + sI is factored (Cholesky, R upper triangular), with a shift s above the
   rounding errors of G in the first pass and while G is near singular;
3. Q becomes Q R^-1 by triangular solves.  Q is never stored: every pass reads
   the integer rows again, centres them and solves with all factors so far.

Passes are repeated (three Gram passes at least) until G is the identity to rounding (or a projector to
rounding, where A lacks rank).  With R = R_k ... R_1, A is Q R, and the singular values
and right vectors of G^(1/2) R are those of A: no Gram matrix of A itself is
ever decomposed, so small components are as exact as large ones.

``whitened`` is the centred row on the components, over the root of their
eigenvalues (divisor n).  Centred rows are (n x - S) / n with an exact integer
numerator.

Shuffles: the distinct vectors once (copies are combined map-side), written
once and read by every pass, dropped after the fit; d x d sums per task and
pass.  To the driver: d x d numbers.

Defined results: rows whose vector is null or empty, or holds a null, NaN or
infinite entry, are neither fitted nor returned; vectors of different lengths
are an error; repeated rows count once in the fit and are returned each.  A
component without variance has eigenvalue 0, ``whitened`` 0 and counts for
nothing in ``identity_error``.  No rows: a model without components.
``deviation`` is null beyond 38 digits.  Other columns stay; those named like
an output are replaced.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import ddl_of, drop_written, fresh, written
from tierline.llm.vectors import grid_vectors, matrix

EPS = float(np.finfo(float).eps)
SAFE = 1 << 62


@dataclass
class WhiteningModel:
    """``components``: one row per component, by falling eigenvalue."""

    n: int
    sums: list[int]                     # per dimension, over the fit list
    scale: int
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: np.ndarray               # eigenvalue / trace of the covariance
    identity_error: float = 0.0         # of the first ``checked`` components
    checked: int = 0
    passes: int = 0
    factors: list[np.ndarray] = field(default_factory=list, repr=False)


def scaled_deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: int64, or Python integers where that is too narrow."""
    most = int(np.abs(x.astype(float)).max(initial=0)) * n + max((abs(s) for s in sums), default=0)
    if most < SAFE:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return scaled_deviations(x, n, sums).astype(float) / n


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a R^-1 for an upper triangular R, column by column."""
    q = np.array(a, float, order="F")
    for j in range(r.shape[0]):
        if j:
            q[:, j] -= q[:, :j] @ r[:j, j]
        q[:, j] /= r[j, j]
    return q


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and sums per dimension, exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            x = matrix(b.column(0), None if total is None else len(total))
            if len(x):
                wide = np.abs(x.astype(float)).max() * len(x) >= SAFE
                part = x.astype(object).sum(axis=0) if wide else x.sum(axis=0).astype(object)
                n, total = n + len(x), part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                                              pa.array([decimal.Decimal(int(s)) for s in total], pa.decimal128(38, 0))], ["i", "n", "s"])

    got = sorted(fit.mapInArrow(run, "i int, n bigint, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    if len({r["n"] for r in got}) > 1:
        raise ValueError("vectors of different lengths")
    return (got[0]["n"] if got else 0), [int(r["s"]) for r in got]


def _gram(fit: DataFrame, n: int, sums: list[int], transform) -> np.ndarray:
    """The Gram matrix of the transformed centred rows: one distributed pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = None
        for b in batches:
            q = transform(centred(matrix(b.column(0), len(sums)), n, sums))
            g = q.T @ q if g is None else g + q.T @ q
        if g is not None:
            i, j = np.triu_indices(len(g))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(g[i, j])], ["i", "j", "g"])

    cells = fit.mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()
    d = int(cells["j"].max()) + 1
    out = np.zeros((d, d))
    out[cells["i"], cells["j"]] = cells["g"]
    return out + np.triu(out, 1).T


def shifted_cholesky(g: np.ndarray, first: bool = True) -> np.ndarray:
    """Upper triangular R with R'R = G + sI.  s is above the rounding errors of
    G (and grows until the factor exists); after the first pass it is 0 where
    G is far from singular."""
    d = len(g)
    low, high = np.linalg.eigvalsh(g)[[0, -1]]
    shift = 0.0 if not first and low > 100 * d * EPS * high else 11 * d * (d + 1) * EPS * max(high, np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, 11 * d * (d + 1) * EPS * high)


def _settled(g: np.ndarray) -> bool:
    """Every singular value of Q is 1 or 0."""
    w = np.linalg.eigvalsh(g)
    return bool(np.minimum(np.abs(w - 1), np.abs(w)).max() < 1e-10)


def fit_whitening(df: DataFrame, vec_col: str = "embedding", scale: int = 256, check: int = 4,
                  max_passes: int = 10) -> WhiteningModel:
    """Fits all components; ``identity_error`` is measured on the first
    ``check`` of them by one more pass over the fit list."""
    x = fresh("x", df)
    fit, path = written(grid_vectors(df, vec_col, scale, x).select(x).distinct(), "whitening-fit")
    spark = df.sparkSession
    try:
        n, sums = _sums(fit)
        d = len(sums)
        if not n:
            return WhiteningModel(0, [], scale, np.zeros(0), np.zeros((0, 0)), np.zeros(0))
        factors: list[np.ndarray] = []

        def solved(a: np.ndarray) -> np.ndarray:
            for r in factors:
                a = solve_right(a, r)
            return a

        g = _gram(fit, n, sums, solved)
        trace = float(np.trace(g)) / n
        passes = 1
        if trace > 0:
            while True:
                factors.append(shifted_cholesky(g, first=not factors))
                g = _gram(fit, n, sums, solved)
                passes += 1
                if passes >= 3 and _settled(g) or passes >= max_passes:
                    break
        r = np.eye(d)
        for f in factors:
            r = f @ r
        w, e = np.linalg.eigh(g)
        _, s, v = np.linalg.svd((np.sqrt(np.maximum(w, 0))[:, None] * e.T) @ r)
        s = np.where(s > s[0] * 4 * max(d, 16) * EPS, s, 0.0)
        v *= np.sign(v[np.arange(d), np.abs(v).argmax(axis=1)])[:, None]
        values = s * s / n
        model = WhiteningModel(n, sums, scale, values, v, values / trace if trace > 0 else np.zeros(d), passes=passes, factors=factors)
        model.checked = min(check, int((values > 0).sum()))
        if model.checked:
            weights = _weights(model, model.checked)
            cov = _gram(fit, n, sums, lambda a: a @ weights) / n
            model.identity_error = float(np.abs(cov - np.eye(model.checked)).max())
        return model
    finally:
        drop_written(spark, path)


def _weights(model: WhiteningModel, k: int) -> np.ndarray:
    """d x k: components over the root of their eigenvalues, 0 without variance."""
    e = model.eigenvalues[:k]
    scale = np.where(e > 0, 1 / np.sqrt(np.where(e > 0, e, 1)), 0.0)
    return model.components[:k].T * scale


def whiten(df: DataFrame, model: WhiteningModel, vec_col: str = "embedding", k: int = 4,
           out: str = "whitened", deviation_col: str = "deviation") -> DataFrame:
    """The rows with a whole vector, with ``out`` (array<double>: the first
    ``k`` components, fewer if there are fewer) and ``deviation_col``
    (decimal(38,0): the sum over dimensions of (n x - S)^2)."""
    df = df.drop(*[c for c in (out, deviation_col) if c != vec_col])
    x = fresh("x", df)
    rows = grid_vectors(df, vec_col, model.scale, x)
    keep = [f for f in df.schema.fields if f.name not in (out, deviation_col)]
    k = min(k, len(model.eigenvalues))
    weights = _weights(model, k) if k else np.zeros((0, 0))
    n, sums = model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dev = scaled_deviations(matrix(b.column(len(keep)), len(sums)), n, sums)
            z = dev.astype(float) / max(n, 1) @ weights
            if len(dev) and dev.dtype != object and (dev.astype(float) ** 2).sum(axis=1).max() < SAFE:
                total = pa.array((dev ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                exact = [int((row.astype(object) ** 2).sum()) for row in dev]
                total = pa.array([decimal.Decimal(v) if v < 10 ** 38 else None for v in exact], pa.decimal128(38, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * k), pa.array(z.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], lists, total], [*b.schema.names[:len(keep)], out, deviation_col])

    made = f"`{out}` array<double>, `{deviation_col}` decimal(38,0)"
    return rows.select(*[f"`{f.name}`" for f in keep], x).mapInArrow(run, ", ".join(filter(None, [ddl_of(keep), made])))
