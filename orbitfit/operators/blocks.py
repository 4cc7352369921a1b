"""Wide-vector Lloyd step: NumPy distance blocks inside ``mapInArrow``.

For large ``K * d`` the literal-centre expression grows to ``K * d`` terms
and Catalyst spends longer optimising it than the data takes to scan. Here
each Arrow batch becomes an ``(n, d)`` array; the kernel forms the ``(n, K)``
squared distances, takes the arg-min (first index on ties, like the
expression path) and emits partial sums in long form ``(cluster, dim, sum)``
plus one count row per cluster, accumulated over the task's batches: at
most ``K * (d + 1)`` rows per task, whatever the partition size. A
``groupBy(cluster, dim)`` then adds them up, so the shuffle stays
``K * (d + 1)`` rows per task and a cluster holding most of the points costs
no more than any other.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTIAL_SCHEMA = "cluster int, dim int, s double"
BLOCK_CELLS = 1 << 15   # row-centre pairs of a block, small enough for a core's cache whatever K and d


def block_rows(k: int) -> int:
    return max(1, BLOCK_CELLS // k)


def nearest_block(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Arg-min cluster and squared distance for each row of ``X``.

    Squares are added one dimension after the other, like the column
    expressions, so both give the same bits; memory is rows x centres.
    """
    d2 = np.zeros((len(X), len(C)))
    for j in range(C.shape[1]):
        diff = X[:, j, None] - C[None, :, j]
        d2 += diff * diff
    idx = np.argmin(d2, axis=1)
    return idx, d2[np.arange(len(X)), idx]


def rows_of(b: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """The points of a batch as a matrix, from a column per dimension or from one array column."""
    if len(names) == 1 and pa.types.is_list(b.schema.field(names[0]).type):
        return b.column(names[0]).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
    return np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names])


def add_up(counts: np.ndarray, sums: np.ndarray, cluster: np.ndarray, X: np.ndarray) -> None:
    """Adds the rows of ``X`` to the sizes and sums of their clusters."""
    counts += np.bincount(cluster, minlength=len(counts))
    for j in range(X.shape[1]):
        sums[:, j] += np.bincount(cluster, weights=X[:, j], minlength=len(counts))


def partial_rows(counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """``(cluster, dim, s)`` of the clusters that hold points; dimension -1 is the count."""
    used, d = np.flatnonzero(counts), sums.shape[1]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(used, d + 1).astype(np.int32)),
         pa.array(np.tile(np.arange(-1, d, dtype=np.int32), len(used))),
         pa.array(np.column_stack([counts[used], sums[used]]).reshape(-1), type=pa.float64())],
        names=["cluster", "dim", "s"])


def make_partial_kernel(names: Sequence[str], centres: Sequence[Sequence[float]]):
    C = np.asarray(centres, dtype=np.float64)
    k, d = C.shape
    names = list(names)

    def kernel(batches):
        counts = np.zeros(k)
        sums = np.zeros((k, d))
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            X = rows_of(b, names)
            idx = np.concatenate([nearest_block(X[lo:lo + block_rows(k)], C)[0] for lo in range(0, n, block_rows(k))])
            add_up(counts, sums, idx, X)
        if counts.any():
            yield partial_rows(counts, sums)

    return kernel


def lloyd_step_blocks(feats: DataFrame, names: Sequence[str], centres: Sequence[Sequence[float]]
                      ) -> tuple[list[tuple[float, ...]], list[int]]:
    """Same contract as :func:`orbitfit.operators.kmeans.lloyd_step`."""
    partial = feats.mapInArrow(make_partial_kernel(names, centres), PARTIAL_SCHEMA)
    return added_up(partial.groupBy("cluster", "dim").agg(F.sum("s").alias("s")).collect(), centres)


def added_up(rows, centres: Sequence[Sequence[float]]) -> tuple[list[tuple[float, ...]], list[int]]:
    """New centres and cluster sizes from the sums per cluster and dimension; an empty cluster keeps its centre."""
    k, d = len(centres), len(centres[0])
    counts = [0] * k
    sums = [[0.0] * d for _ in range(k)]
    for r in rows:
        if r["dim"] < 0:
            counts[r["cluster"]] = int(round(r["s"]))
        else:
            sums[r["cluster"]][r["dim"]] = r["s"]
    new = []
    for i in range(k):
        if counts[i] == 0:
            new.append(tuple(centres[i]))
        else:
            new.append(tuple(sums[i][j] / counts[i] for j in range(d)))
    return new, counts


def make_assign_kernel(names: Sequence[str], centres: Sequence[Sequence[float]]):
    """``mapInArrow`` function appending ``cluster`` and ``d2`` to every row."""
    C = np.asarray(centres, dtype=np.float64)
    names = list(names)

    def kernel(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            X = rows_of(b, names)
            idx = np.empty(len(X), dtype=np.int32)
            d2 = np.empty(len(X))
            step = block_rows(len(C))
            for lo in range(0, len(X), step):
                idx[lo:lo + step], d2[lo:lo + step] = nearest_block(X[lo:lo + step], C)
            cols = [b.column(j) for j in range(b.num_columns)]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(idx), pa.array(d2, type=pa.float64())],
                names=list(b.schema.names) + ["cluster", "d2"])

    return kernel


def assign_blocks(pts: DataFrame, names: Sequence[str], centres: Sequence[Sequence[float]]
                  ) -> DataFrame:
    """Every row of ``pts`` plus its ``cluster`` and ``d2``, computed in NumPy blocks."""
    from pyspark.sql import types as T
    schema = T.StructType(list(pts.schema.fields) + [
        T.StructField("cluster", T.IntegerType(), True), T.StructField("d2", T.DoubleType(), True)])
    return pts.mapInArrow(make_assign_kernel(names, centres), schema)


def with_min_d2(pts: DataFrame, name: str, centres: Sequence[Sequence[float]], out: str) -> DataFrame:
    """Every row plus ``out``, the squared distance of its array point to the nearest centre."""
    from pyspark.sql import types as T
    schema = T.StructType([*pts.schema.fields, T.StructField(out, T.DoubleType(), True)])
    assign = make_assign_kernel([name], centres)

    def kernel(batches):
        for b in assign(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], b.columns[-1]], names=[*b.schema.names[:-2], out])

    return pts.mapInArrow(kernel, schema)
