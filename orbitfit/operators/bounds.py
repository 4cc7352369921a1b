"""Lloyd iterations for many centres, with distance bounds per row.

Every row carries its cluster and a lower bound of its distance to any other
centre from one iteration to the next (Hamerly 2010). When the centres have
moved, the bound shrinks by the largest movement of another centre; the
distance to the row's own centre is computed anew. As long as that one is
smaller than the bound, or than half the distance from its centre to the next
centre (triangle inequality), no other distance is computed. Rounding is allowed
for by a margin, and a row within it is compared with all centres, so clusters
and ties (lowest index) are those of the plain step.

Points travel in blocks, one row for each Arrow batch of the first step: its
coordinates, clusters and bounds as bytes, so that an iteration moves a few large
rows instead of every point. Each iteration writes the blocks, and the partial
sums of its tasks as rows beside them, into a new persisted copy by one Python
stage; the old copy is released. Every ``CUT_EVERY`` iterations the copy is a reliable checkpoint in the
shared folder, so that a lost executor repeats few iterations.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.operators.blocks import PARTIAL_SCHEMA, add_up, added_up, block_rows, partial_rows, rows_of
from orbitfit.session import dematerialize, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CUT_EVERY = 10
MARGIN = 1e-9     # of the distances compared, far above their rounding
CARRIED = ("_points", "_cluster", "_lower")
STATE_SCHEMA = "_points binary, _cluster binary, _lower binary, " + PARTIAL_SCHEMA
STATE_ARROW = pa.schema([*((c, pa.binary()) for c in CARRIED),
                         ("cluster", pa.int32()), ("dim", pa.int32()), ("s", pa.float64())])


def squared(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Squared distances, added one dimension after the other like every other path."""
    d2 = np.zeros((len(X), len(C)))
    for j in range(C.shape[1]):
        diff = X[:, j, None] - C[None, :, j]
        diff *= diff
        d2 += diff
    return d2


def own_squared(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    d2 = np.zeros(len(X))
    for j in range(C.shape[1]):
        diff = X[:, j] - C[:, j]
        d2 += diff * diff
    return d2


def reassign(X: np.ndarray, C: np.ndarray, cluster: np.ndarray | None, lower: np.ndarray | None,
             moved: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Clusters, bounds and number of distances computed of each row.

    ``moved``: how far each centre has moved since ``lower`` was valid.
    """
    n, k = len(X), len(C)
    tried = np.zeros(n, np.int64)
    if cluster is None:
        cluster, lower, open_rows = np.zeros(n, np.int32), np.zeros(n), np.arange(n)
    else:
        far = np.full(k, moved.max(initial=0.0))       # the largest movement of another centre
        if k > 1:
            first = int(moved.argmax())
            far[first] = np.delete(moved, first).max()
        gaps = np.sqrt(squared(C, C))
        np.fill_diagonal(gaps, np.inf)
        half = gaps.min(axis=1) / 2
        cluster, lower = cluster.astype(np.int32), lower - far[cluster] * (1 + MARGIN)
        own = np.sqrt(own_squared(X, C[cluster]))
        tried += 1
        open_rows = np.flatnonzero(own * (1 + MARGIN) >= np.maximum(lower, half[cluster] * (1 - MARGIN)))
    for at in range(0, len(open_rows), block_rows(k)):
        rows = open_rows[at:at + block_rows(k)]
        d2 = squared(X[rows], C)
        best = np.argmin(d2, axis=1)
        cluster[rows] = best
        d2[np.arange(len(rows)), best] = np.inf
        lower[rows] = np.sqrt(d2.min(axis=1)) * (1 - MARGIN)
        tried[rows] += k
    return cluster, lower, tried


def make_bound_kernel(names: Sequence[str], centres: Sequence[Sequence[float]], moved: Sequence[float] | None):
    """``mapInArrow`` function: a row per block of points with its new bounds, then the task's partial sums.

    The first step (``moved`` is None) reads the features, later ones the blocks. The distances
    computed are summed up as cluster -1.
    """
    C = np.asarray(centres, np.float64)
    names = list(names)
    moved = None if moved is None else np.asarray(moved, np.float64)

    def blocks(b):
        if moved is None:
            if b.num_rows:
                yield rows_of(b, names), None, None
            return
        for x, cluster, lower in zip(*(b.column(c) for c in CARRIED)):
            if x.is_valid:
                yield (np.frombuffer(x.as_buffer(), np.float64).reshape(-1, C.shape[1]),
                       np.frombuffer(cluster.as_buffer(), np.int32), np.frombuffer(lower.as_buffer(), np.float64))

    def kernel(batches):
        counts, sums, distances = np.zeros(len(C)), np.zeros(C.shape), 0
        for b in batches:
            for X, cluster, lower in blocks(b):
                cluster, lower, tried = reassign(X, C, cluster, lower, moved)
                add_up(counts, sums, cluster, X)
                distances += int(tried.sum())
                yield state_rows([[np.ascontiguousarray(c).tobytes()] for c in (X, cluster, lower)], [None] * 3)
        if counts.any():
            part = partial_rows(counts, sums)
            yield state_rows([None] * 3, part.columns)
            yield state_rows([None] * 3, [[-1], [0], [float(distances)]])

    return kernel


def state_rows(block: Sequence, partial: Sequence) -> pa.RecordBatch:
    """Rows of the state: either blocks or partial sums, the other columns null."""
    n = max(len(c) for c in (*block, *partial) if c is not None)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, f.type) if c is None else pa.array(c, f.type) if isinstance(c, list) else c
         for c, f in zip([*block, *partial], STATE_ARROW)], schema=STATE_ARROW)


class BoundedSteps:
    """Lloyd steps over ``feats``; each returns new centres and cluster sizes. ``distances`` holds
    the number of distances computed in every step."""

    def __init__(self, feats: DataFrame, names: Sequence[str]):
        self.names, self.state = list(names), feats.select(*names)
        self.kept: tuple[DataFrame, str] | None = None
        self.distances: list[int] = []
        self.moved: list[float] | None = None

    def __call__(self, centres: Sequence[Sequence[float]]) -> tuple[list[tuple[float, ...]], list[int]]:
        new = self.state.mapInArrow(make_bound_kernel(self.names, centres, self.moved), STATE_SCHEMA)
        how = "persist" if (len(self.distances) + 1) % CUT_EVERY else "checkpoint"
        kept = materialize(new, how)
        partial = kept.filter("cluster is not null")
        rows = partial.groupBy("cluster", "dim").agg(F.sum("s").alias("s")).collect()
        found, sizes = added_up([r for r in rows if r["cluster"] >= 0], centres)
        self.distances.append(int(sum(r["s"] for r in rows if r["cluster"] < 0)))
        self.moved = [float(np.sqrt(sum((a - b) ** 2 for a, b in zip(p, q)))) for p, q in zip(centres, found)]
        self.release()
        self.state, self.kept = kept, (kept, how)
        return found, sizes

    def release(self) -> None:
        if self.kept is not None:
            dematerialize(*self.kept)
            self.kept = None
