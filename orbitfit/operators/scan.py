"""Ordered per-shard recurrences as a distributed affine scan.

For the squared loss every per-row update used by the stochastic fits is an
*affine* map of the optimiser state:

* SGD          ``w <- w - s * 2 (w.p - y) p``            (state w)
* heavy ball   ``v <- g v + s * grad(w); w <- w - v``    (state (w, v))
* Nesterov     ``v <- g v + s * grad(look)``             (state (v, look), ``look`` fixed per epoch)

So a shard's ordered pass is a small homogeneous ``(m x m)`` matrix, the product
of its rows' matrices, and its result is linear in the state that the epoch
starts from. The mean over shards is then one matrix as well, and it does not
depend on the state. As the step sizes are known beforehand, *one* pass over the
rows gives the mean matrices of a whole group of epochs, and the driver only
applies them one after the other:

1. rows lie in order in their partitions (:mod:`orbitfit.operators.layout`), a
   hot shard in as many as its size needs;
2. ``mapInArrow`` advances chunks of rows side by side, for all epochs of the
   group at once (a row changes the matrix by an outer product, ``d m`` numbers),
   multiplies the chunks of a run of equal shard pairwise, and emits one summary
   per partition: the maps of its first run (which may continue a shard from the
   previous partition), of its last run (which may go on in the next one) and
   the sum of the maps of the whole shards in between. For Nesterov the maps of
   all epochs differ by the step only, so one map serves any number of epochs;
3. merging the summaries of neighbours gives a summary of the same shape, so
   beyond ``STITCH_FANIN`` partitions groups of that many are merged on
   executors (one small ``applyInArrow`` level per factor of ``STITCH_FANIN``)
   and at most ``STITCH_FANIN`` rows reach the driver.

The results equal the sequential recurrence up to floating-point rounding.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.session import partitions_for

# Ship this module's kernel functions to Python workers by value, so the
# executors need only numpy/pyarrow, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METHODS = ("sgd", "heavy_ball", "nesterov")

# Most partition summaries the driver receives per pass; beyond that they
# are merged on executors first, this many consecutive ones per group.
STITCH_FANIN = 1024
# Rows per partition of a sharded layout (about 0.2 GB of narrow rows, sorted in memory).
ROWS_PER_PARTITION = 2_000_000
# Doubles in the maps a task holds at once (32 MB); wide states take their rows
# in smaller pieces. Beyond MAX_STATE a summary row gets too large.
BLOCK_DOUBLES = 4_000_000
MAX_STATE = 256
# Doubles in the summaries that reach the driver in a pass (64 MB).
DRIVER_DOUBLES = 8_000_000
# Rows that are advanced one after the other; chunks advance side by side.
CHUNK = 64
# Rows that a step takes at once if the bound allows: Arrow batches are smaller.
GATHERED = 100_000


def state_dim(method: str, d: int) -> int:
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    m = d if method == "sgd" else 2 * d
    if m >= MAX_STATE:
        raise ValueError(f"{d} features are too many for the ordered scan (state of {MAX_STATE} at most); "
                         "fit from sufficient statistics instead (full_batch_history)")
    return m


def run_products(M: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One matrix per run, ``M[last] @ ... @ M[first]``; ``starts`` are the first places.

    Every level multiplies the even places of each run by their odd successors.
    """
    size = np.diff(np.append(starts, len(M)))
    while len(M) > len(size):
        place = np.arange(len(M)) - np.repeat(np.cumsum(size) - size, size)
        even = np.flatnonzero(place % 2 == 0)
        paired = np.append(place[1:] % 2 == 1, False)[even]
        out = M[even]
        out[paired] = M[even[paired] + 1] @ out[paired]
        M, size = out, (size + 1) // 2
    return M


def nesterov_maps(y: np.ndarray, P: np.ndarray, starts: np.ndarray, gamma: float) -> np.ndarray:
    """One map per run for step 1, without a matrix per row: n rows take v to
    ``gamma^n v + sum_k gamma^(n-1-k) 2 (p_k.look - y_k) p_k``."""
    n, d = P.shape
    size = np.diff(np.append(starts, n))
    left = np.repeat(starts + size, size) - 1 - np.arange(n)   # rows of the run still to come
    weighted = P * (2.0 * np.power(gamma, left))[:, None]
    M = np.zeros((len(starts), 2 * d + 1, 2 * d + 1))
    M[:, :d, :d] = np.power(gamma, size)[:, None, None] * np.eye(d)
    M[:, :d, d:2 * d] = np.add.reduceat(weighted[:, :, None] * P[:, None, :], starts, axis=0)
    M[:, :d, 2 * d] = -np.add.reduceat(weighted * y[:, None], starts, axis=0)
    M[:, d:, d:] = np.eye(d + 1)
    return M


def chunk_maps(method: str, y: np.ndarray, P: np.ndarray, starts: np.ndarray, rows: np.ndarray,
               steps: np.ndarray, gamma: float) -> tuple[np.ndarray, np.ndarray]:
    """``(chunks, epochs, m, m)`` maps of chunks of ``CHUNK`` rows that do not cross runs, and each run's first chunk.

    ``rows``: the row at every place, one line for all epochs or one per epoch.
    """
    n, d, epochs = rows.shape[1], P.shape[1], len(steps)
    size = np.diff(np.append(starts, n))
    per = -(-size // CHUNK)
    first = np.cumsum(per) - per
    begin = np.repeat(starts, per) + CHUNK * (np.arange(int(per.sum())) - np.repeat(first, per))
    length = np.minimum(CHUNK, np.repeat(starts + size, per) - begin)
    order = np.argsort(-length, kind="stable")    # at every place the chunks that go on are the first ones
    begin, length = begin[order], length[order]
    m = state_dim(method, d) + 1
    w = np.zeros((len(begin), epochs, d, m))
    w[..., range(d), range(d)] = 1.0
    v = None
    if method == "heavy_ball":
        v = np.zeros_like(w)
        v[..., range(d), range(d, 2 * d)] = 1.0
    double_step = 2.0 * steps[None, :, None]
    for t in range(int(length[0]) if len(length) else 0):
        on = int(np.count_nonzero(length > t))
        at = rows[:, begin[:on] + t].T                       # (chunks, 1 or epochs)
        p = P[at]
        r = p[..., :1] * w[:on, :, 0]                        # p.w as a row over the starting state
        for j in range(1, d):
            r += p[..., j:j + 1] * w[:on, :, j]
        r[..., -1] -= y[at]
        up = p[..., None] * (double_step * r)[:, :, None, :]
        if v is None:
            w[:on] -= up
        else:
            v[:on] *= gamma
            v[:on] += up
            w[:on] -= v[:on]
    out = np.zeros((len(begin), epochs, m, m))
    out[order, :, :d] = w
    if v is not None:
        out[order, :, d:2 * d] = v
    out[..., m - 1, m - 1] = 1.0
    return out, first


def run_maps(method: str, y: np.ndarray, P: np.ndarray, starts: np.ndarray, steps: Sequence[float], gamma: float,
             rows: np.ndarray | None = None) -> np.ndarray:
    """``(runs, epochs, m, m)``: the map of every run of rows for every step size (Nesterov: one for step 1)."""
    if method == "nesterov":
        return nesterov_maps(y, P, starts, gamma)[:, None]
    rows = np.arange(len(y))[None, :] if rows is None else rows
    return run_products(*chunk_maps(method, y, P, starts, rows, np.asarray(steps, np.float64), gamma))


def pieces(batches, doubles: int):
    """Non-empty slices of the batches whose maps (``doubles`` per row) stay within ``BLOCK_DOUBLES``."""
    rows = max(1, BLOCK_DOUBLES // doubles)
    for b in gathered(batches, min(rows, GATHERED)):
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def gathered(batches, rows: int):
    """Consecutive batches joined until they hold ``rows`` rows."""
    kept, n = [], 0
    for b in batches:
        kept.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.concat_batches(kept)
            kept, n = [], 0
    if n:
        yield pa.concat_batches(kept)


class Summary:
    """Maps of consecutive rows: of the first run, of the last one (if there are two), and the
    sum and number of the runs between."""

    def __init__(self, first_shard, first, last_shard=None, last=None, mid=0.0, mid_count=0):
        self.first_shard, self.first = first_shard, first
        self.last_shard, self.last = last_shard, last
        self.mid, self.mid_count = mid, mid_count

    @classmethod
    def of_runs(cls, shards: np.ndarray, maps: np.ndarray) -> Summary:
        if len(shards) == 1:
            return cls(int(shards[0]), maps[0])
        return cls(int(shards[0]), maps[0], int(shards[-1]), maps[-1], maps[1:-1].sum(axis=0), len(shards) - 2)

    def then(self, after: Summary) -> Summary:
        """The summary of these rows and those of ``after``, which follow."""
        mid, count = self.mid + after.mid, self.mid_count + after.mid_count
        one = self.last is None
        shard, run = (self.first_shard, self.first) if one else (self.last_shard, self.last)
        first = self.first
        if shard == after.first_shard:
            run = after.first @ run               # the run goes on
            if one:
                return Summary(shard, run, after.last_shard, after.last, mid, count)
        elif one:
            run, shard = after.first, after.first_shard
        else:
            mid, count = mid + run, count + 1     # the run has ended between two others
            run, shard = after.first, after.first_shard
        if after.last is None:
            return Summary(self.first_shard, first, shard, run, mid, count)
        return Summary(self.first_shard, first, after.last_shard, after.last, mid + run, count + 1)

    def total(self) -> tuple[np.ndarray, int]:
        """Sum of the maps of all runs, and their number."""
        total, count = self.first + self.mid, 1 + self.mid_count
        return (total, count) if self.last is None else (total + self.last, count + 1)

    def row(self, part: int) -> dict:
        def packed(m):
            return None if m is None else np.ascontiguousarray(m, np.float64).tobytes()
        mid = self.mid if self.mid_count else None
        return {"part": part, "first_shard": self.first_shard, "first_map": packed(self.first),
                "last_shard": self.last_shard, "last_map": packed(self.last), "mid_sum": packed(mid),
                "mid_count": self.mid_count}

    @classmethod
    def of_row(cls, r, m: int) -> Summary:
        def unpacked(b):
            return None if b is None else np.frombuffer(b, np.float64).reshape(-1, m, m)
        mid = unpacked(r["mid_sum"])
        return cls(r["first_shard"], unpacked(r["first_map"]), r["last_shard"], unpacked(r["last_map"]),
                   0.0 if mid is None else mid, r["mid_count"])


def merged(rows, m: int) -> Summary | None:
    """One summary of consecutive summary rows, given in any order."""
    acc = None
    for r in sorted(rows, key=lambda r: r["part"]):
        s = Summary.of_row(r, m)
        acc = s if acc is None else acc.then(s)
    return acc


SUMMARY_SCHEMA = ("part int, first_shard long, first_map binary, last_shard long, last_map binary, "
                  "mid_sum binary, mid_count long")
_ARROW_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
SUMMARY_ARROW = pa.schema([(c.split()[0], _ARROW_TYPES[c.split()[1]]) for c in SUMMARY_SCHEMA.split(", ")])


def columns(b: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, y, P) of a batch of a layout."""
    shard, y, *p = (b.column(c).to_numpy(zero_copy_only=False) for c in ["shard", "y", *(f"p{j}" for j in range(d))])
    return shard.astype(np.int64), y.astype(np.float64), np.column_stack(p).astype(np.float64)


def run_starts(shard: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))


def ordered_runs(d: int, doubles: int) -> Callable:
    """Pieces of a partition as (shard, y, P, rows): rows in the order in which they lie."""
    def read(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches, doubles):
            yield *columns(b, d), None
    return read


def permuted_runs(d: int, epochs: int, doubles: int) -> Callable:
    """Whole shards of a partition as (shard, y, P, rows), the rows of every shard in the order of the
    epoch's column of ``u``. Holds one shard and one batch at a time."""
    limit = max(1, BLOCK_DOUBLES // doubles)

    def read(batches: Iterator[pa.RecordBatch]):
        kept: list = []
        for b in batches:
            if not b.num_rows:
                continue
            u = b.column("u").flatten().to_numpy(zero_copy_only=False).reshape(-1, epochs)
            part = (*columns(b, d), u)
            cut = run_starts(part[0])[-1]
            if cut == 0 and kept and kept[-1][0][-1] == part[0][0]:
                kept.append(part)       # still the same shard
                continue
            head, tail = [c[:cut] for c in part], [c[cut:] for c in part]
            yield from whole([*kept, head])
            kept = [tail]
        yield from whole(kept)

    def whole(parts):
        parts = [p for p in parts if len(p[0])]
        if parts:
            shard, y, P, u = (np.concatenate(c) for c in zip(*parts))
            starts = np.append(run_starts(shard), len(shard))
            place = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            a = 0
            while a < len(starts) - 1:     # as many shards as the maps' bound allows, one at least
                b = max(a + 1, int(np.searchsorted(starts, starts[a] + limit, side="right")) - 1)
                i, j = starts[a], starts[b]
                rows = np.stack([np.lexsort((u[i:j, e], place[i:j])) for e in range(epochs)])
                yield shard[i:j], y[i:j], P[i:j], rows
                a = b
    return read


def make_map_kernel(method: str, d: int, steps: Sequence[float], gamma: float, chain: bool = False,
                    permuted: bool = False):
    """``mapInArrow`` function: one ``Summary`` row per non-empty partition, whose rows lie in order.

    ``chain``: all rows are one run, whatever their shard. ``permuted``: the rows of a shard, which
    lie in one partition, are taken in the order of column ``u``, one value per epoch.
    """
    m = state_dim(method, d) + 1
    steps = [1.0] if method == "nesterov" else list(steps)
    doubles = len(steps) * m * m
    read = permuted_runs(d, len(steps), doubles) if permuted else ordered_runs(d, doubles)

    def kernel(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        acc = None
        for shard, y, P, rows in read(batches):
            if chain:
                shard = np.zeros_like(shard)
            starts = run_starts(shard)
            summary = Summary.of_runs(shard[starts], run_maps(method, y, P, starts, steps, gamma, rows))
            acc = summary if acc is None else acc.then(summary)
        if acc is not None:
            yield pa.RecordBatch.from_pylist([acc.row(0 if ctx is None else ctx.partitionId())], schema=SUMMARY_ARROW)

    return kernel


def layout_partitions(spark, rows: int) -> int:
    """Partitions for a layout of ``rows`` rows: about ``ROWS_PER_PARTITION``
    each (see ``session.partitions_for``)."""
    return partitions_for(spark, rows, ROWS_PER_PARTITION)


def epochs_per_pass(method: str, d: int, partitions: int) -> int:
    """Epochs whose maps one pass gives, so that summaries and pieces stay bounded."""
    doubles = (state_dim(method, d) + 1) ** 2
    return max(1, min(DRIVER_DOUBLES // (3 * doubles * min(partitions, STITCH_FANIN)), BLOCK_DOUBLES // (1024 * doubles)))


def _group_merger(m: int, fanin: int):
    """``applyInArrow`` function: merge one group of consecutive summaries."""

    def fn(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        part = min(r["part"] for r in rows) // fanin
        return pa.Table.from_pylist([merged(rows, m).row(part)], schema=SUMMARY_ARROW)

    return fn


def reduce_levels(df: DataFrame, m: int, bound: int, fanin: int | None = None) -> DataFrame:
    """Merge ordered per-partition summaries on executors until at most ``fanin`` remain.

    Each level groups ``fanin`` consecutive ``part`` ids; the new ``part`` is the
    group id, so order is kept. Lazy: the levels run in the same job as ``df``.
    """
    fanin = fanin or STITCH_FANIN
    while bound > fanin:
        df = (df.groupBy(F.expr(f"part div {int(fanin)}").alias("_grp"))
              .applyInArrow(_group_merger(m, fanin), SUMMARY_SCHEMA))
        bound = math.ceil(bound / fanin)
    return df


def mean_maps(layout: DataFrame, method: str, d: int, steps: Sequence[float], gamma: float, bound: int,
              chain: bool = False, permuted: bool = False) -> np.ndarray:
    """``(epochs, m, m)``: for every step size the unweighted mean over the shards of the map that a shard's
    ordered pass applies to the state; with ``chain`` the map of one pass through all shards in turn.

    One Python stage over the ordered layout of at most ``bound`` partitions, no shuffle of rows. Nesterov
    gives one map, for step 1.
    """
    m = state_dim(method, d) + 1
    rows = layout.mapInArrow(make_map_kernel(method, d, steps, gamma, chain, permuted), SUMMARY_SCHEMA)
    found = merged(reduce_levels(rows, m, bound).collect(), m)
    if found is None:
        raise ValueError("no rows to fit")
    total, count = found.total()
    return total / count


def advance(method: str, step: float, gamma: float, M: np.ndarray, w: np.ndarray, v: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """State after one epoch whose mean map is ``M``."""
    d = len(w)
    if method == "sgd":
        return M[:d, :d] @ w + M[:d, d], v
    if method == "heavy_ball":
        z = M[:2 * d] @ np.r_[w, v, 1.0]
        return z[:d], z[d:]
    look = w - gamma * v
    v = M[:d, :d] @ v + step * (M[:d, d:2 * d] @ look + M[:d, 2 * d])
    return w - v, v
