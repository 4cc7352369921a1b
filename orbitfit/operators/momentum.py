"""Sharded stochastic fits with model averaging.

Every shard starts an epoch from the same state, runs the per-row recurrence
over its rows in order, and the end states are averaged over the non-empty
shards (unweighted, as in the reference). The ordered pass is the affine
scan of :mod:`orbitfit.operators.scan`, so a shard of any size is split over
tasks, and one pass over the rows serves all epochs of a group whose maps stay
within the bounds there (about 150 epochs for two features, any number for
Nesterov). The number of Spark jobs does not depend on the number of epochs of
a group: statistics (which give every epoch's loss), layout, pass.

* ``heavy_ball``: rows in stored ``order``; velocity carried across epochs.
* ``nesterov``: look-ahead ``w - gamma v`` fixed for the epoch; each shard
  returns ``w - v_shard``. Weights decay like ``gamma^k`` with the number k
  of later rows, so in long shards early rows contribute ~0 (underflow), as
  in the sequential recurrence.
* ``local_sgd``: rows visited in a seeded permutation per shard; with
  ``permute="epoch"`` (reference behaviour) a fresh permutation each epoch,
  ``"once"`` a single permutation, ``"none"`` stored order. Fresh permutations
  are made inside the tasks while every shard fits one (``PERMUTED_ROWS``);
  otherwise each epoch deals the rows anew, over cuts that are counted once.
  One shard reproduces row-by-row SGD.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.functions.random import hash_uniform, key_text, text_uniform
from orbitfit.operators.layout import as_layout, ordered_cuts, sorted_layout
from orbitfit.operators.linear import normal_stats, step_size
from orbitfit.operators.scan import advance, epochs_per_pass, layout_partitions, mean_maps
from orbitfit.session import dematerialize, materialize

# Rows of the largest shard that a task permutes itself, and the doubles of its sort keys.
PERMUTED_ROWS = 1_000_000
PERMUTED_DOUBLES = 16_000_000


@dataclass
class FitResult:
    method: str
    d: int
    w: list[float]
    v: list[float]
    history: list[tuple] = field(default_factory=list)  # (epoch, step, w.., v.., loss)

    def history_df(self, spark: SparkSession, w_names: Sequence[str] | None = None,
                   v_names: Sequence[str] | None = None) -> DataFrame:
        """Long-lived history table (G6): one row per epoch, explicit epoch column."""
        w_names = list(w_names or [f"w{j}" for j in range(self.d)])
        nv = len(self.v)
        v_names = list(v_names or [f"v{j}" for j in range(nv)])[:nv]
        fields = [T.StructField("epoch", T.IntegerType(), False),
                  T.StructField("step", T.DoubleType(), False)]
        fields += [T.StructField(n, T.DoubleType(), False) for n in w_names]
        fields += [T.StructField(n, T.DoubleType(), False) for n in v_names]
        fields += [T.StructField("loss", T.DoubleType(), False)]
        rows = []
        for h in self.history:
            e, s = h[0], h[1]
            ws = list(h[2:2 + self.d])
            vs = list(h[2 + self.d:2 + self.d + nv])
            rows.append((e, s, *ws, *vs, h[-1]))
        return spark.createDataFrame(rows, T.StructType(fields))

    def register_views(self, spark: SparkSession, prefix: str = "", w_names: Sequence[str] | None = None,
                       v_names: Sequence[str] | None = None) -> None:
        """``weightHistoryView``, ``lossHistoryView``, ``velocityHistoryView``.

        ``w_names`` and ``v_names`` name the columns, for a line for instance
        ``slope, intercept`` and ``velocity_slope, velocity_intercept``.
        """
        w_names = list(w_names or [f"w{j}" for j in range(self.d)])
        v_names = list(v_names or [f"v{j}" for j in range(len(self.v))])
        h = self.history_df(spark, w_names, v_names)
        h.select("epoch", *w_names).createOrReplaceTempView(
            f"{prefix}weightHistoryView")
        h.select("epoch", "loss").createOrReplaceTempView(f"{prefix}lossHistoryView")
        if self.v:
            h.select("epoch", *v_names[:len(self.v)]).createOrReplaceTempView(
                f"{prefix}velocityHistoryView")


def _run(method: str, y: str, phi: Sequence[str], epochs: int, s0: float, decay: float, momentum: float, w0,
         stats, passes: Iterator[np.ndarray]) -> FitResult:
    """Fold the mean maps of the epochs, one after the other; ``passes`` gives them in order."""
    d = len(phi)
    w = np.array(w0 if w0 is not None else [0.0] * d, np.float64)
    v = np.zeros(d)
    hist = []
    for e, M in zip(range(1, epochs + 1), passes):
        s = step_size(s0, decay, e)
        w, v = advance(method, s, momentum, M, w, v)
        hist.append((e, s, *w.tolist(), *(v.tolist() if method != "sgd" else ()), stats.loss(w.tolist())))
    return FitResult(method, d, w.tolist(), v.tolist() if method != "sgd" else [], hist)


def _ordered(method: str, df: DataFrame, y: str, phi: Sequence[str], shard: str, order: Sequence[str],
             epochs: int, s0: float, decay: float, momentum: float, w0, cache: str,
             combine: str = "average") -> FitResult:
    """A fit whose rows keep one order over all epochs."""
    d, chain = len(phi), _chained(combine)
    stats = normal_stats(df, y, phi)
    # the layout is sized from the row count the statistics pass just gave
    parts = layout_partitions(df.sparkSession, stats.n)
    group = epochs if method == "nesterov" else epochs_per_pass(method, d, parts)
    layout = sorted_layout(df, shard, order, y, phi, stats.n, parts)
    if epochs > group:
        layout = materialize(layout, cache)

    def passes():
        for e in range(1, epochs + 1, group):
            steps = [step_size(s0, decay, k) for k in range(e, min(e + group, epochs + 1))]
            maps = mean_maps(layout, method, d, steps, momentum, parts, chain)
            yield from (maps[0 if method == "nesterov" else k] for k in range(len(steps)))

    try:
        return _run(method, y, phi, epochs, s0, decay, momentum, w0, stats, passes())
    finally:
        if epochs > group:
            dematerialize(layout, cache)


def _chained(combine: str) -> bool:
    if combine not in ("average", "sequential"):
        raise ValueError("combine must be 'average' or 'sequential'")
    return combine == "sequential"


def heavy_ball(df: DataFrame, y: str, phi: Sequence[str], shard: str, order: Sequence[str],
               epochs: int = 50, s0: float = 1e-7, decay: float = 0.01, momentum: float = 0.6,
               w0: Sequence[float] | None = None, cache: str = "persist") -> FitResult:
    """Heavy-ball momentum per shard, averaged each epoch."""
    return _ordered("heavy_ball", df, y, phi, shard, order, epochs, s0, decay, momentum, w0, cache)


def nesterov(df: DataFrame, y: str, phi: Sequence[str], shard: str, order: Sequence[str],
             epochs: int = 50, s0: float = 1e-7, decay: float = 0.01, momentum: float = 0.6,
             w0: Sequence[float] | None = None, cache: str = "persist") -> FitResult:
    """Nesterov accelerated gradient per shard, averaged each epoch."""
    return _ordered("nesterov", df, y, phi, shard, order, epochs, s0, decay, momentum, w0, cache)


def permutation_key(keys: Sequence[str], seed: int, epoch: int | None):
    """Seeded per-row sort key for the within-shard permutation."""
    return hash_uniform(keys, seed) if epoch is None else hash_uniform(keys, seed, epoch)


def local_sgd(df: DataFrame, y: str, phi: Sequence[str], shard: str, order: Sequence[str],
              epochs: int = 10, s0: float = 1e-8, decay: float = 0.01, seed: int = 42,
              permute: str = "epoch", w0: Sequence[float] | None = None,
              cache: str = "persist", combine: str = "average") -> FitResult:
    """SGD over shards (G3); ``order`` identifies rows.

    ``combine="average"``: local SGD with model averaging, every shard from
    the same weights. ``combine="sequential"``: one chain visiting the shards
    in shard order and the rows of each in their permuted order, carrying the
    weights from shard to shard, as a driver loop over all rows would; it is
    still computed in parallel through the affine scan.
    """
    if permute == "none":
        return _ordered("sgd", df, y, phi, shard, order, epochs, s0, decay, 0.0, w0, cache, combine)
    if permute == "once":
        keyed = df.withColumn("_perm", permutation_key(order, seed, None))
        return _ordered("sgd", keyed, y, phi, shard, ["_perm", *order], epochs, s0, decay, 0.0, w0, cache, combine)
    if permute != "epoch":
        raise ValueError("permute must be 'epoch', 'once' or 'none'")
    d, chain = len(phi), _chained(combine)
    # The used columns are projected and persisted once, with the row id that keeps equal keys apart.
    cols = list(dict.fromkeys([shard, *order, y, *phi]))
    largest = df.groupBy(shard).count().agg(F.max("count")).first()[0] or 0
    base = df.select(*cols).withColumn("_tie", F.monotonically_increasing_id())
    if largest > PERMUTED_ROWS:
        base = _with_key_text(base, [shard, *order[:1], y, *phi, "_tie"], order, seed)
    base = materialize(base, cache)
    layout = None
    try:
        stats = normal_stats(base, y, phi)
        parts = layout_partitions(df.sparkSession, stats.n)
        if largest <= PERMUTED_ROWS:
            group = min(epochs_per_pass("sgd", d, parts), max(1, PERMUTED_DOUBLES // max(1, largest)))
            layout = materialize(sorted_layout(base, shard, order, y, phi, stats.n, parts, "_tie", order, True), cache)
            passes = _permuted_passes(layout, d, len(order), epochs, group, s0, decay, seed, parts, chain)
        else:
            passes = _dealt_passes(base, y, phi, shard, order, epochs, s0, decay, seed, stats.n, parts, chain)
        return _run("sgd", y, phi, epochs, s0, decay, 0.0, w0, stats, passes)
    finally:
        for kept in (base, layout):
            if kept is not None:
                dematerialize(kept, cache)


def _permuted_passes(layout: DataFrame, d: int, n_order: int, epochs: int, group: int, s0: float, decay: float,
                     seed: int, parts: int, chain: bool) -> Iterator[np.ndarray]:
    """Whole shards lie in a partition: a pass draws the permutations of a group of epochs inside the tasks."""
    keys = [F.col(f"k{j}") for j in range(n_order)]
    for e in range(1, epochs + 1, group):
        last = min(e + group, epochs + 1) - 1
        u = F.transform(F.sequence(F.lit(e), F.lit(last)), lambda k: hash_uniform(keys, seed, k))
        drawn = layout.select("shard", "y", *[f"p{j}" for j in range(d)], u.alias("u"))
        steps = [step_size(s0, decay, k) for k in range(e, last + 1)]
        yield from mean_maps(drawn, "sgd", d, steps, 0.0, parts, chain, permuted=True)


def _with_key_text(df: DataFrame, cols: Sequence[str], order: Sequence[str], seed: int) -> DataFrame:
    """``cols``, and as ``_keys`` the text of the keys and the seed that every epoch hashes with its number."""
    numbers = [c for c in order if isinstance(df.schema[c].dataType, T.NumericType)]
    return df.select(*dict.fromkeys(cols), key_text(order, seed, numbers=numbers).alias("_keys"))


def _dealt_passes(base: DataFrame, y: str, phi: Sequence[str], shard: str, order: Sequence[str], epochs: int,
                  s0: float, decay: float, seed: int, rows: int, parts: int, chain: bool) -> Iterator[np.ndarray]:
    """Shards too large for a task: every epoch deals the rows anew. Permutations are equally spread, so the
    cuts counted for the first epoch serve them all.

    Only what the pass reads is shuffled. Rows of one place in the permutation have equal keys, or their
    52-bit hashes collide: the first key tells those apart, the row id the others."""
    cuts = None
    for e in range(1, epochs + 1):
        keyed = base.withColumn("_perm", text_uniform(F.concat_ws(":", "_keys", F.lit(str(e))))).drop("_keys")
        if cuts is None:
            cuts = ordered_cuts(keyed, [shard, "_perm"], rows, parts)
            cuts.keys = list(dict.fromkeys([shard, "_perm", *order[:1], "_tie"]))
            if isinstance(base.schema[shard].dataType, T.IntegralType):
                cuts.lead = (f"if(`{shard}` BETWEEN -1000000000000 AND 1000000000000, "
                             f"`{shard}` + _perm, cast(`{shard}` AS double))")
        layout = as_layout(cuts.deal(keyed), shard, y, phi)
        yield from mean_maps(layout, "sgd", len(phi), [step_size(s0, decay, e)], 0.0, cuts.partitions, chain)
