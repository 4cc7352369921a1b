"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers x = floor(64 c) + 1000000, so equal vectors are equal
bit for bit and sums are exact. The fit list (each distinct x vector once) is
written as blocks of rows. From it come the leading eigenvectors of the
covariance V, without ever forming V:

* ``apply`` is one distributed pass, V Q = XᵀXQ / n with centred X: a task
  multiplies its blocks and returns one partial product (dimensions x columns),
  and the partial products are added up by dimension;
* a few Lanczos passes bound the spectrum from below;
* each round filters the block Q by a Chebyshev polynomial of V, computed by
  its three-term recurrence (a pass per degree): it stays small on the unwanted
  part of the spectrum and grows steeply above it. Then come QR and
  Rayleigh-Ritz, whose pass also gives the residuals;
* the block has more columns than components wanted, and its last ones start
  anew at random each round, so that a direction missed so far shows up. The
  result is certified when every wanted residual is below ``TOLERANCE`` times
  the largest eigenvalue in a round that changed none of the wanted values.

Centring is exact: an integer shift, then the remaining fraction of the mean.
A pass's driver state is dimensions x columns numbers, whatever the row count.
The whitened rows' covariance is measured in a last pass over the fit list.

Cases: a vector that is null, empty, or holds a null or a non-finite component
is left out, as are vectors whose length is not the commonest one (of equally
common lengths the largest counts); repeated rows and null identifiers are
returned with their values; components whose variance is zero to rounding
cannot be whitened and are not returned (a single distinct vector has none);
an exact deviation beyond a long raises an error; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import written
from orbitfit.session import materialize

COMPONENTS = 16
GUARD = 20            # columns beyond the components
FRESH = 4             # of these start anew at random each round
DEGREE = 10           # of the filter polynomial
LANCZOS = 10
ROUNDS = 60
TOLERANCE = 1e-12
BLOCK_BYTES = 4 << 20
SCALE, SHIFT = 64, 1_000_000


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(key, x): usable vectors of the commonest length as arrays of longs."""
    v = F.col("v")
    found = rows.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    found = found.filter(v.isNotNull() & (F.size(v) > 0) & ~bad)
    lengths = found.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = lengths["d"] if lengths else 0
    return found.filter(F.size(v) == dim).select("key", F.transform(v, lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_blocks(vectors: DataFrame) -> DataFrame:
    """The distinct vectors as blocks: rows, data (int64, row after row)."""
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, BLOCK_BYTES // max(1, 8 * len(batch.column(0)[0]))) if batch.num_rows else 1
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int64()),
                     pa.array([matrix(part.column(0)).astype("<i8").tobytes()], pa.binary())], ["rows", "data"])

    return written(vectors.select("x").distinct().mapInArrow(block, "rows bigint, data binary"), "fit-list")


@dataclass
class Centre:
    """Row count and exact sums of the fit list."""
    n: int
    sums: list[int]

    @property
    def dim(self) -> int:
        return len(self.sums)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in double precision."""
        shift = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - shift).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum of (n x - S)^2 of every row, exact; an error beyond a long."""
        shift = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], object)
        off = x - shift
        reach = (float(np.abs(off).max(initial=0)) + 1) * self.n
        if reach * reach * self.dim < 2.0 ** 62:
            off = off * self.n - rest.astype(np.int64)
            return (off * off).sum(axis=1)
        off = off.astype(object) * self.n - rest
        return np.array((off * off).sum(axis=1).tolist(), np.int64)


def decoded(data: pa.Array, dim: int) -> Iterator[np.ndarray]:
    for row in data:
        yield np.frombuffer(row.as_buffer(), "<i8").reshape(-1, dim)


def summed(blocks: DataFrame, partial: Callable[[Iterator[np.ndarray]], np.ndarray], shape: tuple[int, int],
           dim: int, kind: str = "double") -> np.ndarray:
    """Sum over all tasks of a task's matrix ``partial(its blocks)``, added up row by row of the matrix."""
    names = [f"c{j}" for j in range(shape[1])]
    arrow = pa.float64() if kind == "double" else pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = partial(x for batch in batches for x in decoded(batch.column(0), dim))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(shape[0]), pa.int32()), *(pa.array(found[:, j].tolist(), arrow) for j in range(shape[1]))],
            ["i", *names])

    schema = ", ".join(["i int", *(f"{c} {kind}" for c in names)])
    got = blocks.select("data").mapInArrow(run, schema).groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).collect()
    out = np.zeros(shape, np.float64 if kind == "double" else object)
    for r in got:
        out[r["i"]] = r[1:] if kind == "double" else [int(v) for v in r[1:]]
    return out


def centre(blocks: DataFrame, dim: int) -> Centre:
    """Exact sums, added up as decimals."""
    def partial(xs: Iterator[np.ndarray]) -> np.ndarray:
        total, n = np.zeros(dim, object), 0
        for x in xs:
            low = x.min(axis=0)   # small differences cannot overflow in a block
            total, n = total + (x - low).sum(axis=0).astype(object) + low.astype(object) * len(x), n + len(x)
        return np.array([[t, n] for t in total.tolist()], object)

    got = summed(blocks, partial, (dim, 2), dim, "decimal(38,0)")
    return Centre(int(got[0, 1]), [int(v) for v in got[:, 0]])


def apply(blocks: DataFrame, at: Centre, q: np.ndarray) -> np.ndarray:
    """V Q: one pass over the fit list."""
    def partial(xs: Iterator[np.ndarray]) -> np.ndarray:
        out = np.zeros(q.shape)
        for x in xs:
            c = at.rows(x)
            out += c.T @ (c @ q)
        return out

    return summed(blocks, partial, q.shape, at.dim) / at.n


def trace(blocks: DataFrame, at: Centre) -> float:
    """Trace of V."""
    def partial(xs: Iterator[np.ndarray]) -> np.ndarray:
        return np.array([[sum(float((c * c).sum()) for c in map(at.rows, xs))]])

    return float(summed(blocks, partial, (1, 1), at.dim)[0, 0]) / at.n


def spectrum_floor(times: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int) -> float:
    """A lower bound of most of the spectrum: the smallest Lanczos value less its residual."""
    basis, alpha, beta = [start / np.linalg.norm(start)], [], []
    for _ in range(min(steps, len(start))):
        w = times(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):
            for b in basis:
                w = w - (w @ b) * b
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-13 * max(abs(a) for a in alpha) or len(basis) == len(start):
            beta[-1] = 0.0
            break
        basis.append(w / beta[-1])
    k = len(alpha)
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:k - 1], 1) + np.diag(beta[:k - 1], -1))
    return max(0.0, float(values[0] - beta[k - 1] * abs(vectors[-1, 0])))


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, low: float, high: float,
              top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial of V times Q: small on [low, high], steep above, about 1 at ``top``."""
    half, mid = (high - low) / 2, (high + low) / 2
    scale = half / (top - mid)
    first = scale
    before, now = q, (times(q) - mid * q) * (scale / half)
    for _ in range(2, degree + 1):
        after = 1 / (2 / first - scale)
        before, now = now, (times(now) - mid * now) * (2 * after / half) - (scale * after) * before
        scale = after
    return now


@dataclass
class Model:
    """Leading eigenvectors (columns) and eigenvalues of the fit list's covariance."""
    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residual: float      # largest residual of a component over the largest eigenvalue


def leading(times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, degree: int = DEGREE,
            tolerance: float = TOLERANCE, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues of a positive operator, their vectors and the largest residual."""
    rng = np.random.default_rng(seed)
    block = min(dim, wanted + GUARD)
    q = np.linalg.qr(rng.standard_normal((dim, block)))[0]
    floor, known = None, None
    for _ in range(ROUNDS):
        image = times(q)                       # Rayleigh-Ritz on the block
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        size = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(image - q * values, axis=0)[:wanted].max(initial=0.0))
        steady = known is not None and np.abs(values[:wanted] - known).max(initial=0.0) <= tolerance * size
        if block == dim or size == 0.0 or (steady and residual <= tolerance * size):
            return values[:wanted], q[:, :wanted], residual / size if size else 0.0
        known = values[:wanted]
        if floor is None:
            floor = spectrum_floor(times, rng.standard_normal(dim), LANCZOS)
        # The last columns were fresh, their values are low. A block inside one repeated value ends its interval below it.
        high = min(float(values[-1 - FRESH]), floor + 0.9 * (float(values[wanted - 1]) - floor))
        high = max(high, 1e-9 * size)
        q[:, block - FRESH:] = rng.standard_normal((dim, FRESH)) / np.sqrt(dim)
        q = np.linalg.qr(chebyshev(times, q, degree, min(floor, high / 2), high, max(size, high * 1.01)))[0]
    raise ArithmeticError(f"not converged in {ROUNDS} rounds (residual {residual / size:.1e})")


def fit(blocks: DataFrame, dim: int, components: int = COMPONENTS) -> Model:
    """Mean, leading components and their certificate, by distributed passes over the fit list."""
    at = centre(blocks, dim)
    total = trace(blocks, at)
    values, vectors, residual = leading(lambda q: apply(blocks, at, q), dim, min(components, dim))
    real = values > max(1e-13 * total, 0.0)
    values, vectors = values[real], vectors[:, real]

    def partial(xs: Iterator[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(values), len(values)))
        for x in xs:
            w = at.rows(x) @ vectors / np.sqrt(values)
            out += w.T @ w
        return out

    k = len(values)
    error = float(np.abs(summed(blocks, partial, (k, k), dim) / at.n - np.eye(k)).max()) if k else 0.0
    return Model(at, values, vectors, total, error, residual)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Per usable row: id, deviation (exact), whitened (array, one value per component), and of the fit
    n, explained (array), identity_error, residual."""
    vectors = integer_vectors(rows, id_col, vector_col)
    kind = vectors.schema[0].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, n bigint, deviation bigint, whitened array<double>, explained array<double>, "
              "identity_error double, residual double")
    blocks = fit_blocks(vectors)
    first = blocks.select((F.octet_length("data") / F.col("rows") / 8).cast("int")).first()
    if first is None:
        return rows.sparkSession.createDataFrame([], schema)
    kept = materialize(blocks)
    try:
        model = fit(kept, first[0], components)
    finally:
        kept.unpersist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        onto = model.vectors / np.sqrt(model.values)
        explained = (model.values / model.trace).tolist() if len(model.values) else []
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1))
                n = len(x)
                white = model.centre.rows(x) @ onto
                ends = np.arange(n + 1, dtype=np.int32) * white.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([model.centre.n] * n, pa.int64()),
                     pa.array(model.centre.deviations(x), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel())),
                     pa.array([explained] * n, pa.list_(pa.float64())),
                     pa.array([model.identity_error] * n), pa.array([model.residual] * n)],
                    [id_col, "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return vectors.mapInArrow(run, schema)
