"""Least-squares building blocks.

The model is ``y ~ w . phi`` with squared loss. Everything that is a mean
over rows is one Spark aggregate (partial per task, one row to the driver):

* ``column_moments`` / ``standardize``: count, mean and population deviation
  of every column in one pass (G1); a constant column standardises to 0.0.
* ``normal_stats``: sufficient statistics in one pass (G7). From them the
  loss and gradient of *any* weight vector follow with no further job, so a
  full-batch fit of any number of epochs costs a single scan, and the
  per-epoch loss of the stochastic fits needs no extra job either. They are
  centred co-moments (which merge over tasks) of the features and of the
  residual of reference weights, not raw sums: with raw sums the loss of a good
  fit is a small difference of large numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitfit.functions.vector import check_valid, dot, squared_loss_gradient


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def column_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long table ``(column, n, mean, stddev)``; one pass, population deviation."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"),
                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"))
        for i, c in enumerate(cols)
    ])
    return wide.select(F.inline(rows))


def moments(df: DataFrame, cols: Sequence[str]) -> tuple[int, list[float], list[float]]:
    """Driver-side ``(n, means, deviations)`` from one aggregate row."""
    r = df.agg(F.count(F.lit(1)).alias("n"),
               *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
               *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]
               ).collect()[0]
    return int(r["n"]), [r[f"m{i}"] for i in range(len(cols))], [r[f"s{i}"] for i in range(len(cols))]


def standardize_exprs(cols: Sequence[str], means: Sequence[float], sds: Sequence[float]) -> list[Column]:
    """``(x - mean) / sd``; a zero deviation gives 0.0 (H9), a NaN in the column NaN; NULL stays NULL."""
    out = []
    for c, m, s in zip(cols, means, sds):
        if s is None or s == 0.0:
            out.append(F.when(F.col(c).isNotNull(), F.lit(0.0)).alias(c))
        else:
            out.append(((F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(c))
    return out


def standardize(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()
                ) -> tuple[DataFrame, list[float], list[float]]:
    """Standardised columns plus the means and deviations used (G1)."""
    _, means, sds = moments(df, cols)
    return df.select(*[F.col(k) for k in keep], *standardize_exprs(cols, means, sds)), means, sds


@dataclass
class NormalStats:
    """Sufficient statistics of least squares, around reference weights ``ref``.

    ``mean`` and ``cov`` are the means and population covariances of the
    features and, last, of the residual ``r = y - ref . phi``. Any residual is
    ``r - (w - ref) . phi``, so its mean square is its squared mean plus a
    quadratic form of ``cov``, taken through a factor of it: never negative,
    and without cancellation as long as ``ref`` fits about as well as ``w``.
    """
    n: int
    ref: list[float]
    mean: list[float]
    cov: list[list[float]]

    @property
    def d(self) -> int:
        return len(self.ref)

    @cached_property
    def _factor(self) -> np.ndarray:
        """F with ``F'F = cov``, through the correlations, so that scales apart do not mix."""
        cov = np.asarray(self.cov)
        sd = np.sqrt(np.diag(cov))
        inv = np.divide(1.0, sd, out=np.zeros_like(sd), where=sd > 0)
        values, vectors = np.linalg.eigh(cov * inv[:, None] * inv[None, :])
        return np.sqrt(np.maximum(values, 0.0))[:, None] * vectors.T * sd[None, :]

    def _residual(self, w: Sequence[float]) -> tuple[np.ndarray, float]:
        """Coefficients of the residual of ``w`` over (features, r), and its mean."""
        z = np.append(np.asarray(self.ref) - np.asarray(w, np.float64), 1.0)
        return z, float(z @ np.asarray(self.mean))

    def loss(self, w: Sequence[float]) -> float:
        """Mean squared error of the weights."""
        z, mean = self._residual(w)
        f = self._factor @ z
        return float(f @ f) + mean * mean

    def grad(self, w: Sequence[float]) -> list[float]:
        """Mean per-row gradient ``-2 E[phi residual]``."""
        z, mean = self._residual(w)
        cross = np.asarray(self.cov)[:self.d] @ z
        return (-2.0 * (cross + np.asarray(self.mean[:self.d]) * mean)).tolist()

    @property
    def xtx(self) -> list[list[float]]:
        """Phi'Phi."""
        m = np.asarray(self.mean[:self.d])
        return (self.n * (np.asarray(self.cov)[:self.d, :self.d] + np.outer(m, m))).tolist()

    @property
    def xty(self) -> list[float]:
        """Phi'y."""
        m, ref = np.asarray(self.mean), np.append(self.ref, 1.0)
        return (self.n * (np.asarray(self.cov)[:self.d] @ ref + m[:self.d] * (m @ ref))).tolist()


def complete_rows(df: DataFrame, y: str | Column, phi: Sequence[str | Column], invalid: str = "error"
                  ) -> tuple[DataFrame, Column, list[Column]]:
    """``(df, y, phi)`` under one NULL / NaN policy: an error, or the row is dropped as a whole."""
    (yc, *ps), ok = check_valid([_col(c).cast("double") for c in (y, *phi)], invalid)
    return (df if ok is None else df.where(ok)), yc, ps


# Rows that the reference weights are fitted on; they only decide how much is left to cancel.
REFERENCE_ROWS = 1000


def reference_weights(df: DataFrame, y: Column, phi: Sequence[Column]) -> list[float]:
    """Least-squares weights of a few rows, rounded to 20 binary digits so that products with features
    of up to 33 digits are exact. Zeros where the rows give none."""
    rows = df.select(*[p.alias(f"p{i}") for i, p in enumerate(phi)], y.alias("y")).limit(REFERENCE_ROWS).collect()
    data = np.array([tuple(r) for r in rows], np.float64).reshape(len(rows), len(phi) + 1)
    scale = np.abs(data).max(axis=0, initial=0.0)
    if not np.isfinite(scale).all() or not scale[-1] or not scale[:-1].any():
        return [0.0] * len(phi)
    scale[scale == 0.0] = 1.0
    found = np.linalg.lstsq(data[:, :-1] / scale[:-1], data[:, -1] / scale[-1], rcond=None)[0] * scale[-1] / scale[:-1]
    digits, exponent = np.frexp(found)
    return np.ldexp(np.round(digits * 2.0 ** 20), exponent - 20).tolist()


def normal_stats(df: DataFrame, y: str | Column, phi: Sequence[str | Column], invalid: str = "error") -> NormalStats:
    """One aggregate: row count, means and covariances of the features and of the residual of weights
    fitted on ``REFERENCE_ROWS`` rows."""
    df, yc, ps = complete_rows(df, y, phi, invalid)
    d = len(ps)
    ref = reference_weights(df, yc, ps)
    cols = [*ps, yc - dot(ref, ps)]
    aggs = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]]
    aggs += [F.covar_pop(cols[i], cols[j]).alias(f"v{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)]
    r = df.agg(*aggs).collect()[0]
    if not r["n"]:
        raise ValueError("no rows to fit")
    cov = [[float(r[f"v{min(i, j)}_{max(i, j)}"]) for j in range(d + 1)] for i in range(d + 1)]
    return NormalStats(int(r["n"]), ref, [float(r[f"m{i}"]) for i in range(d + 1)], cov)


def normal_stats_table(df: DataFrame, y: str | Column, phi: Sequence[str | Column],
                       invalid: str = "error") -> DataFrame:
    """The same statistics as a long table ``(i, j, value)`` built in Spark.

    ``i = j = -1`` holds ``y'y``; ``j = -1`` holds ``Phi'y``; ``i = -1, j = -2``
    holds n. One aggregate, then an in-plan ``inline`` to long form.
    """
    df, yc, ps = complete_rows(df, y, phi, invalid)
    d = len(ps)
    entries = [(-1, -2, F.count(F.lit(1)).cast("double")), (-1, -1, F.sum(yc * yc))]
    for i in range(d):
        entries.append((i, -1, F.sum(ps[i] * yc)))
        for j in range(i, d):
            entries.append((i, j, F.sum(ps[i] * ps[j])))
    wide = df.agg(*[e.alias(f"e{k}") for k, (_, _, e) in enumerate(entries)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"e{k}").alias("value"))
        for k, (i, j, _) in enumerate(entries)
    ])
    return wide.select(F.inline(rows))


def mse(df: DataFrame, y: str | Column, phi: Sequence[str | Column], w: Sequence[float]) -> Column:
    """Aggregate expression: mean squared error of fixed weights."""
    r = _col(y) - dot(list(w), [_col(p) for p in phi])
    return F.avg(r * r)


def gradient(df: DataFrame, y: str | Column, phi: Sequence[str | Column], w: Sequence[float]
             ) -> list[Column]:
    """Aggregate expressions: mean per-row gradient, one per component (M8)."""
    g = squared_loss_gradient(_col(y), [_col(p) for p in phi], list(w))
    return [F.avg(c) for c in g]


def step_size(s0: float, decay: float, epoch: int) -> float:
    """``s0 / (1 + decay * epoch)``, epochs counted from 1."""
    return s0 / (1.0 + decay * epoch)


def full_batch_history(stats: NormalStats, method: str, epochs: int, s0: float, decay: float,
                       momentum: float = 0.0, w0: Sequence[float] | None = None
                       ) -> list[tuple]:
    """Full-batch GD / heavy ball / Nesterov from sufficient statistics.

    Rows ``(epoch, step, w_0..w_{d-1}, v_0..v_{d-1}, loss)``; the loss is
    that of the weights after the epoch. No Spark job: the statistics
    already hold everything.
    """
    d = stats.d
    w = list(w0) if w0 is not None else [0.0] * d
    v = [0.0] * d
    out = []
    for e in range(1, epochs + 1):
        s = step_size(s0, decay, e)
        if method == "gd":
            g = stats.grad(w)
            w = [w[i] - s * g[i] for i in range(d)]
        elif method == "heavy_ball":
            g = stats.grad(w)
            v = [momentum * v[i] + s * g[i] for i in range(d)]
            w = [w[i] - v[i] for i in range(d)]
        elif method == "nesterov":
            look = [w[i] - momentum * v[i] for i in range(d)]
            g = stats.grad(look)
            v = [momentum * v[i] + s * g[i] for i in range(d)]
            w = [w[i] - v[i] for i in range(d)]
        else:
            raise ValueError(f"unknown method {method!r}")
        out.append((e, s, *w, *v, stats.loss(w)))
    return out
