"""Running totals in a seeded random order (W1) and the threshold draw (P10).

A global ``sum(..) OVER (ORDER BY ..)`` runs in a single task. Here the rows
are range-partitioned on the whole order key ``(u, keys..., _tie)`` into B
partitions and sorted inside each, so every partition is a contiguous slice
of the global order:

1. per-partition totals, added left to right like the running sums: B rows;
2. partition offsets: an exclusive running sum over those B rows;
3. per-partition running sums: a ``mapInArrow`` cumulative sum over the
   sorted batches, plus the partition's offset joined back on ``_part``.

Every sum is carried as two floats, the rounded sum and the sum of the exact
rounding errors of its additions, inside partitions and over the offsets, and
rounded once at the end. A total therefore does not depend on where the
partitions are cut, whatever the weights.

``_tie`` (a row id) only separates exact copies: rows equal on ``(u, keys)``
are interchangeable, so their relative order does not change the result,
but with the id in the key the range bounds can cut a group of copies that
holds a third of all rows into many partitions. The order key ``u`` is a
seeded uniform, so distinct keys spread evenly anyway.

B defaults to about ``ROWS_PER_BUCKET`` rows per partition, spread over the
cores while each keeps at least ``session.MIN_ROWS_PER_TASK`` (one count). The
partition count is explicit, so adaptive execution never coalesces these
partitions and both reads of the one range shuffle see the same partition
ids. The offset table has exactly B rows; it is broadcast only while
``B <= BROADCAST_MAX_BUCKETS``, else joined by shuffle.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.functions.random import TWO_52
from orbitfit.session import partitions_for

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scalar_uniform(*salt: int | str) -> float:
    """The seeded uniform of a key-less draw, same formula as ``hash_uniform``."""
    h = hashlib.md5(":".join(str(s) for s in salt).encode()).hexdigest()
    return (int(h[:13], 16) + 0.5) / TWO_52


# About 0.7 GB of rows of ten columns; the sort spills beyond memory.
ROWS_PER_BUCKET = 8_000_000
BROADCAST_MAX_BUCKETS = 2_000_000


def bucket_count(spark, rows: int) -> int:
    """Partitions for a running total over ``rows`` rows: about
    ``ROWS_PER_BUCKET`` each (see ``session.partitions_for``)."""
    return partitions_for(spark, rows, ROWS_PER_BUCKET)


def two_float_sums(w: np.ndarray, high: float, low: float) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of ``w`` after ``high + low``, the start included: rounded sums, added left to
    right, and the sums of their rounding errors (each exact, after Knuth)."""
    with np.errstate(invalid="ignore"):
        return _two_float_sums(w, high, low)


def _two_float_sums(w: np.ndarray, high: float, low: float) -> tuple[np.ndarray, np.ndarray]:
    s = np.cumsum(np.concatenate(([high], w)))
    part = s[1:] - s[:-1]
    error = (s[:-1] - (s[1:] - part)) + (w - part)
    error[~np.isfinite(error)] = 0.0      # beyond an infinite weight the sums stay infinite
    return s, np.cumsum(np.concatenate(([low], error)))


def _weights(b: pa.RecordBatch, weight: str) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(b.column(weight).cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)


def _local_sums_kernel(weight: str):
    """``mapInArrow`` function: running sums of ``weight`` inside the (sorted)
    partition, before and through each row, plus the partition id. NULL adds 0."""

    def kernel(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx is not None else 0
        high = low = 0.0
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            s, e = two_float_sums(_weights(b, weight), high, low)
            high, low = float(s[-1]), float(e[-1])
            yield pa.RecordBatch.from_arrays(
                list(b.columns) + [pa.array(np.full(n, part, dtype=np.int32)), pa.array(s[:-1]), pa.array(e[:-1]),
                                   pa.array(s[1:]), pa.array(e[1:])],
                names=list(b.schema.names) + list(LOCAL))

    return kernel


# Partition, and the two floats of the sums before and through a row.
LOCAL = ("_part", "_bh", "_bl", "_th", "_tl")


# Slices of u that ``u_slices`` counts (at most so many rows reach the driver).
SLICES = 1024


def u_slices(u: Column) -> Column:
    """Slice of ``u`` for counting: see ``evenly_sliced``."""
    return F.floor(u * SLICES)


def evenly_sliced(counts: Sequence[int], buckets: int) -> bool:
    """Whether equal slices of ``u`` make even partitions, from the row counts of the slices.

    Keys draw ``u`` uniformly, so only copies of a key can crowd a slice. A
    slice may exceed the mean by its noise and by one partition's worth.
    """
    mean = sum(counts) / SLICES
    return max(counts, default=0) <= mean + 8 * math.sqrt(mean) + sum(counts) / buckets


def ordered_layout(df: DataFrame, u: str, keys: Sequence[str], buckets: int,
                   tie: str | None = None, even: bool = False) -> DataFrame:
    """Rows range-partitioned on ``(u, keys..., _tie)`` into ``buckets``
    partitions and sorted inside each: partition i holds the i-th slice of
    the global order.

    ``_tie`` splits groups of copies: the column ``tie`` (a unique row id) or,
    when not given, ``monotonically_increasing_id()`` taken here. A position
    id is only reproducible on a task retry if the rows arrive in a fixed
    order (a file scan does; a shuffle read does not), so for an input that
    went through a shuffle, take the id at the scan and pass it as ``tie``.

    ``even``: the caller knows that no group of copies crowds a slice of ``u``
    (``evenly_sliced``). Partition i is then the i-th of ``buckets`` equal
    slices of ``u``: no pass over the input to sample range bounds.
    """
    tie_col = F.col(tie) if tie else F.monotonically_increasing_id()
    order = [F.col(u), *[F.col(k) for k in keys], F.col("_tie")]
    if even:
        part = F.least(F.floor(F.col(u) * buckets), F.lit(buckets - 1)).cast("int")
        return df.withColumn("_tie", tie_col).repartitionById(buckets, part).sortWithinPartitions(*order)
    return (df.withColumn("_tie", tie_col)
            .repartitionByRange(buckets, *order).sortWithinPartitions(*order))


def _partition_total_kernel(weight: str):
    """``mapInArrow`` function: ``(partition id, total of weight)`` as two floats, one row."""

    def kernel(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx is not None else 0
        high = low = 0.0
        seen = False
        for b in batches:
            if b.num_rows:
                s, e = two_float_sums(_weights(b, weight), high, low)
                high, low, seen = float(s[-1]), float(e[-1]), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([high]), pa.array([low])],
                                             names=list(OFFSETS))

    return kernel


OFFSETS = ("_part", "_oh", "_ol")


def _offsets_kernel(batches):
    """``mapInArrow`` function: exclusive running sums of the partition totals, which lie in order."""
    high = low = 0.0
    for b in batches:
        if b.num_rows:
            part, h, l = b.columns
            s, e = two_float_sums(h.to_numpy(zero_copy_only=False), high, low)
            e = e + np.concatenate(([0.0], np.cumsum(l.to_numpy(zero_copy_only=False))))
            high, low = float(s[-1]), float(e[-1])
            yield pa.RecordBatch.from_arrays([part, pa.array(s[:-1]), pa.array(e[:-1])], names=list(OFFSETS))


def _added(high: str, low: str) -> Column:
    """Offset plus local sum, four floats, rounded once (the error of adding the high parts is exact)."""
    a, b = F.col(OFFSETS[1]), F.col(high)
    s = a + b
    part = s - a
    exact = s + (((a - (s - part)) + (b - part)) + (F.col(OFFSETS[2]) + F.col(low)))
    return F.when(F.abs(s) == float("inf"), s).otherwise(exact)


def running_total(df: DataFrame, weight: str, u: str, keys: Sequence[str],
                  buckets: int | None = None, tie: str | None = None, even: bool = False) -> DataFrame:
    """Adds ``cum_before`` (exclusive) and ``cum_through`` (inclusive) of ``weight``
    in the order ``(u, keys...)``; rows equal on all of them are copies.
    ``tie``: optional unique row id separating copies; ``even``: no group of copies
    crowds a slice of ``u`` (see ``ordered_layout`` for both)."""
    if buckets is None:
        buckets = bucket_count(df.sparkSession, df.count())
    lay = ordered_layout(df, u, keys, buckets, tie, even)
    out_schema = T.StructType([*lay.schema.fields, T.StructField(LOCAL[0], T.IntegerType()),
                               *[T.StructField(c, T.DoubleType()) for c in LOCAL[1:]]])
    local = lay.mapInArrow(_local_sums_kernel(weight), out_schema)
    # Both branches consume whole rows of ``lay``, so no column is pruned
    # below the range exchange and the second branch reuses the first's shuffle.
    schema = "_part int, _oh double, _ol double"
    totals = lay.mapInArrow(_partition_total_kernel(weight), schema)
    # B rows of three numbers, in one task
    offsets = totals.repartition(1).sortWithinPartitions("_part").mapInArrow(_offsets_kernel, schema)
    return (
        local.join(F.broadcast(offsets) if buckets <= BROADCAST_MAX_BUCKETS else offsets, "_part")
        .select(*[c for c in df.columns if c != tie],
                _added("_bh", "_bl").alias("cum_before"), _added("_th", "_tl").alias("cum_through"))
    )


def threshold_draw(cum: DataFrame, weight: str, u: str, keys: Sequence[str], r: float,
                   cols: Sequence[str] = (), total: float | None = None) -> DataFrame:
    """The first row (in ``(u, keys)`` order) whose inclusive total reaches
    ``r * total``: an inverse-CDF weighted draw. One row; none if no row
    qualifies or the total is not positive.

    ``total``: the sum of ``weight``. Pass it when it is at hand (one plain
    aggregate over the input); otherwise it is summed from ``cum``, which
    runs the running-total plan one more time.
    """
    if total is None:
        total = cum.agg(F.sum(weight).alias("t")).collect()[0]["t"] or 0.0
    picked = (
        cum.where(F.col("cum_through") >= F.lit(r) * F.lit(float(total)))
        .agg(F.min(F.struct(F.col(u), *[F.col(k) for k in keys], *[F.col(c) for c in cols],
                            F.col("cum_through"))).alias("p"))
    )
    return picked.where(F.col("p").isNotNull() & F.lit(float(total) > 0)).select("p.*")
