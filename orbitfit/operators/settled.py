"""Lloyd iterations of fits that go on for long, over the points that can still change their cluster.

A pass over all points with the centres C gives the cluster sums and the gap of each point: how much
farther its second nearest centre is than its nearest one. As long as no two centres have together
moved by ``reach`` from C, a point with a gap of ``reach`` or more keeps its cluster (triangle
inequality). The pass adds up these settled points and hands the others, the open ones, to the driver,
which sorts them by gap; while the centres stay within reach, an iteration compares those alone and adds
their sums to those of the settled points. Then the next pass follows. While the centres still move too far
for that, every iteration is a pass. So a step is always one of all points, and its clusters, also ties
(lowest index), are those of the plain step.

``reach`` comes from the gaps that the last pass counted, such that the open points are at most
``OPEN_VALUES`` coordinates and a share of all points; a block of points hands over no more than twice
its part of them and says up to which gap they are complete.

Distances are matrix products; where two are closer than the rounding error of those, the row is compared
again by the plain block. Points travel as bytes, in single precision if that holds their values exactly.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.operators.blocks import add_up, block_rows, nearest_block, partial_rows, rows_of
from orbitfit.session import dematerialize, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACKED_SCHEMA = "_points binary, _single boolean"
PACKED_ARROW = pa.schema([("_points", pa.binary()), ("_single", pa.bool_())])
PASS_SCHEMA = f"cluster int, dim int, s double, {PACKED_SCHEMA}, _cluster binary, _gap binary"
PASS_ARROW = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("s", pa.float64()), *PACKED_ARROW,
                        ("_cluster", pa.binary()), ("_gap", pa.binary())])
GAPS, TASKS = -1, -2        # as clusters: counts of gaps by their octave eighth, number of tasks

PACKED_VALUES = 1 << 19     # coordinates in a row of packed points
CHUNK_VALUES = 1 << 17      # coordinates that are compared at once, small enough for a core's cache
OPEN_VALUES = 1 << 23       # coordinates of open points on the driver (64 MB), twice as many at worst
OPEN_SHARE = 4              # at most one in so many points is open
WORTH = 1.0                 # open points are fetched if the centres may move so many times as far as they last did
TASK_VALUES = 1 << 23       # coordinates that a task of a pass reads, at least, once all cores have one
DIRECT_TASKS = 256          # above, the partial sums of the tasks are added up before they reach the driver
MARGIN = 1e-9               # of the distances compared, far above their rounding
EIGHTHS, LOWEST = 8, -2000  # gaps are counted by eighths of octaves from 2^-250 to 2^250


def nearest_two(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster of each row, as ``nearest_block`` gives it, and a lower bound of its gap."""
    with np.errstate(all="ignore"):
        x2, c2 = np.einsum("ij,ij->i", X, X), np.einsum("ij,ij->i", C, C)
        d2 = C @ X.T
        d2 *= -2
        d2 += x2
        d2 += c2[:, None]
        cluster, first, second = np.zeros(len(X), np.int32), d2[0].copy(), np.full(len(X), np.inf)
        for j in range(1, len(C)):
            np.copyto(cluster, j, where=d2[j] < first)
            np.minimum(second, np.maximum(first, d2[j]), out=second)
            np.minimum(first, d2[j], out=first)
        slack = (x2 + c2.max()) * (8 * (C.shape[1] + 8) * np.finfo(np.float64).eps)
        gap = np.sqrt(np.maximum(second - slack, 0)) * (1 - MARGIN)
        gap -= np.sqrt(np.maximum(first, 0) + slack) * (1 + MARGIN)
        unsure = np.flatnonzero(~(second - first > 2 * slack))
    for at in range(0, len(unsure), block_rows(len(C))):
        rows = unsure[at:at + block_rows(len(C))]
        cluster[rows] = nearest_block(X[rows], C)[0]
    gap[unsure] = 0
    return cluster, np.where(gap > 0, gap, 0)


def sum_up(counts: np.ndarray, sums: np.ndarray, cluster: np.ndarray, X: np.ndarray,
           kept: np.ndarray | None = None) -> None:
    """``add_up`` of the rows that ``kept`` marks (all, if it is not given) by a matrix product."""
    kept = np.ones(len(X), bool) if kept is None else kept
    member = np.zeros((len(X), len(counts)))
    member[np.arange(len(X)), cluster] = kept
    with np.errstate(all="ignore"):
        part = member.T @ X
    if np.isfinite(part).all():
        counts += member.sum(axis=0)
        sums += part
    else:                      # a value that is not finite would spoil the other clusters
        add_up(counts, sums, cluster[kept], X[kept])


def packed(X: np.ndarray) -> tuple[bytes, bool]:
    with np.errstate(all="ignore"):
        single = X.astype(np.float32)
    exact = bool((single == X).all())
    return np.ascontiguousarray(single if exact else X).tobytes(), exact


def unpacked(points: pa.Scalar, single: pa.Scalar, d: int) -> np.ndarray:
    """The points of a packed row, in the precision they are held in."""
    return np.frombuffer(points.as_buffer(), np.float32 if single.as_py() else np.float64).reshape(-1, d)


def make_pack_kernel(names: Sequence[str]):
    names = list(names)

    def kernel(batches):
        for b in batches:
            if b.num_rows:
                X = rows_of(b, names)
                step = max(1, PACKED_VALUES // X.shape[1])
                for at in range(0, len(X), step):
                    points, single = packed(X[at:at + step])
                    yield pa.RecordBatch.from_arrays([pa.array([points], pa.binary()), pa.array([single])],
                                                     schema=PACKED_ARROW)

    return kernel


def gap_bins(gap: np.ndarray) -> np.ndarray:
    """Which eighth of an octave each gap lies in, counted from 0."""
    with np.errstate(divide="ignore"):
        eighth = np.floor(np.log2(gap) * EIGHTHS)
    return (np.clip(eighth, LOWEST, -LOWEST) - LOWEST).astype(np.int64)


def make_pass_kernel(centres: Sequence[Sequence[float]], reach: float, share: float):
    """``mapInArrow`` function over packed points: for each block its points with a gap under ``reach``,
    at most twice its ``share``, with their clusters and gaps, and in ``s`` the gap under which none is
    missing (no row if there are none up to ``reach``); then the sums of the others, the counts of all gaps and one row for the task."""
    C = np.asarray(centres, np.float64)
    k, d = C.shape

    step = max(1, CHUNK_VALUES // d)

    def open_gap(gap) -> float:
        """The gap up to which a block hands over its points."""
        most = math.ceil(2 * share * len(gap))
        if reach > 0 and np.count_nonzero(gap < reach) > most:
            return float(np.partition(gap, most)[most])
        return reach

    def open_rows(X, single, cluster, gap, cut):
        rows = np.flatnonzero(gap < cut)
        values = X[rows].tobytes(), single, cluster[rows].tobytes(), gap[rows].tobytes()
        none = pa.nulls(1, pa.int32())
        return pa.RecordBatch.from_arrays(
            [none, none, pa.array([cut]), *[pa.array([v], f.type) for v, f in zip(values, list(PASS_ARROW)[3:])]],
            schema=PASS_ARROW)

    def long(part: pa.RecordBatch) -> pa.RecordBatch:
        rest = [pa.nulls(part.num_rows, f.type) for f in list(PASS_ARROW)[3:]]
        return pa.RecordBatch.from_arrays([*part.columns, *rest], schema=PASS_ARROW)

    def kernel(batches):
        counts, sums, bins = np.zeros(k), np.zeros((k, d)), np.zeros(1 - 2 * LOWEST)
        for b in batches:
            for points, single in zip(b.column(0), b.column(1)):
                X = unpacked(points, single, d)
                x = X.astype(np.float64)
                found = [nearest_two(x[at:at + step], C) for at in range(0, len(x), step)]
                cluster, gap = (np.concatenate(c) for c in zip(*found))
                cut = open_gap(gap)
                for at in range(0, len(x), step):
                    part = slice(at, at + step)
                    sum_up(counts, sums, cluster[part], x[part], gap[part] >= cut)
                bins += np.bincount(gap_bins(gap), minlength=len(bins))
                if (gap < cut).any() or cut < reach:
                    yield open_rows(X, single.as_py(), cluster, gap, cut)
        if counts.any():
            yield long(partial_rows(counts, sums))
        used = np.flatnonzero(bins)
        yield long(pa.RecordBatch.from_arrays(
            [pa.array([GAPS] * len(used) + [TASKS], pa.int32()), pa.array([*used, 0], pa.int32()),
             pa.array([*bins[used], 1.0], pa.float64())], names=["cluster", "dim", "s"]))

    return kernel


def two_largest(moved: np.ndarray) -> float:
    """By how much two centres can have moved apart from or towards a point."""
    lengths = np.sort(np.sqrt((moved * moved).sum(axis=1)))
    return float(lengths[-2:].sum())


def reach_of(bins: np.ndarray, most: float) -> float:
    """The gap that about ``most`` points lie under, as counted."""
    below = np.cumsum(bins)
    at = int(np.searchsorted(below, most, side="right"))    # the bin that goes beyond
    if at == len(bins):
        return math.inf
    if at == 0:
        return 0.0
    low, high = (2.0 ** ((b + LOWEST) / EIGHTHS) for b in (at, at + 1))
    return low + (high - low) * (most - below[at - 1]) / bins[at]


class SettledSteps:
    """Lloyd steps over ``feats``; each returns new centres and cluster sizes. ``passes`` counts
    those that read all points."""

    def __init__(self, feats: DataFrame, names: Sequence[str], cache: str = "persist"):
        self.cores, self.cache = feats.sparkSession.sparkContext.defaultParallelism, cache
        self.points = materialize(feats.select(*names).mapInArrow(make_pack_kernel(names), PACKED_SCHEMA), cache)
        self.read = self.points            # in fewer tasks, once a pass has counted them
        self.passes = 0
        self.tasks: int | None = None
        self.bins: np.ndarray | None = None
        self.base: np.ndarray | None = None    # centres of the pass that the open points come from
        self.X: np.ndarray | None = None       # those points
        self.reach = 0.0
        self.last = math.inf               # how far two centres went in the last step

    def __call__(self, centres: Sequence[Sequence[float]]) -> tuple[list[tuple[float, ...]], list[int]]:
        C = np.asarray(centres, np.float64)
        moved = math.inf if self.base is None else two_largest(C - self.base) * (1 + MARGIN)
        counts, sums = self._among_open(C, moved) if moved < self.reach else self._pass(C)
        found = [tuple(float(v) for v in s / n) if n else tuple(c) for s, n, c in zip(sums, counts, centres)]
        self.last = two_largest(np.asarray(found) - C)
        return found, [int(n) for n in counts]

    def _pass(self, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, d = C.shape
        reach = share = 0.0
        self.base = self.X = None
        if self.bins is not None:
            n = self.bins.sum()
            most = min(OPEN_VALUES / d, n / OPEN_SHARE)
            reach, share = reach_of(self.bins, most), most / n
            if not reach > WORTH * self.last:
                reach = 0.0
        sums, blocks = self._run(C, reach, share)
        self.passes += 1
        cluster, dim, s = (sums.column(c).to_numpy() for c in ("cluster", "dim", "s"))
        long, self.bins = np.zeros((k, d + 1)), np.zeros(1 - 2 * LOWEST)
        np.add.at(long, (cluster[cluster >= 0], dim[cluster >= 0] + 1), s[cluster >= 0])
        np.add.at(self.bins, dim[cluster == GAPS], s[cluster == GAPS])
        tasks = int(s[cluster == TASKS].sum())
        if self.tasks is None:
            values = self.bins.sum() * d
            self.tasks = min(tasks, max(self.cores, math.ceil(values / TASK_VALUES)))
            self.read = self.points.coalesce(self.tasks) if self.tasks < tasks else self.points
        self.counts, self.sums = long[:, 0], long[:, 1:]
        if not reach > 0:
            return self.counts, self.sums
        self._open(C, blocks, reach)
        return self._among_open(C, 0.0)

    def _run(self, C: np.ndarray, reach: float, share: float):
        """What the tasks of a pass give: long rows and blocks of open points, as Arrow tables."""
        kernel = make_pass_kernel(C, reach, share)
        if self.tasks is not None and self.tasks <= DIRECT_TASKS:
            out = self.read.mapInArrow(kernel, PASS_SCHEMA).toArrow()
            return out.filter(out.column("cluster").is_valid()), out.filter(out.column("cluster").is_null())
        kept = materialize(self.read.mapInArrow(kernel, PASS_SCHEMA), "persist")
        try:
            sums = kept.filter("cluster is not null").groupBy("cluster", "dim").agg(F.sum("s").alias("s")).toArrow()
            return sums, kept.filter("cluster is null").toArrow() if reach > 0 else None
        finally:
            dematerialize(kept, "persist")

    def _open(self, C: np.ndarray, blocks: pa.Table, reach: float) -> None:
        """Keeps the open points of a pass, those with the smallest gaps first."""
        column = {c: blocks.column(c) for c in blocks.column_names}
        self.reach = min([reach, *column["s"].to_pylist()])
        points = [np.zeros((0, C.shape[1]), np.float32),
                  *(unpacked(p, single, C.shape[1]) for p, single in zip(column["_points"], column["_single"]))]
        gap = np.frombuffer(b"".join(column["_gap"].to_pylist()), np.float64)
        cluster = np.frombuffer(b"".join(column["_cluster"].to_pylist()), np.int32)
        order = np.argsort(gap, kind="stable")
        self.X, self.gap, self.cluster = np.concatenate(points)[order].astype(np.float64), gap[order], cluster[order]
        self.base, self.step = C, max(1, CHUNK_VALUES // C.shape[1])
        # what the chunks from each one on add while their points stay in their clusters
        self.rest = [(np.zeros_like(self.counts), np.zeros_like(self.sums))]
        for at in reversed(range(0, len(self.X), self.step)):
            counts, sums = (part.copy() for part in self.rest[0])
            sum_up(counts, sums, self.cluster[at:at + self.step], self.X[at:at + self.step])
            self.rest.insert(0, (counts, sums))

    def _among_open(self, C: np.ndarray, moved: float) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and sums, with the open points in the clusters they are in after the centres ``moved``."""
        chunks = math.ceil(int(np.searchsorted(self.gap, moved, side="right")) / self.step) if moved > 0 else 0
        counts, sums = (settled + rest for settled, rest in zip((self.counts, self.sums), self.rest[chunks]))
        for at in range(0, chunks * self.step, self.step):
            X = self.X[at:at + self.step]
            sum_up(counts, sums, nearest_two(X, C)[0], X)
        return counts, sums

    def release(self) -> None:
        dematerialize(self.points, self.cache)
        self.base = self.X = None
