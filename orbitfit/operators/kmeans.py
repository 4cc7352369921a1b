"""Lloyd's k-means (K1, K2, K4) and its model object.

Physical shape of one iteration (checked with ``explain``)::

    InMemoryTableScan(x1..xd) -> Project(nearest centre, literals)
      -> HashAggregate(partial: cluster, count, sum x_j)
      -> Exchange hashpartitioning(cluster)      # <= K rows per task
      -> HashAggregate(final) -> collect K rows

Only the feature columns are cached (MEMORY_AND_DISK). Centres travel as
literals in the plan, the shuffle carries at most K rows per task whatever
the cluster sizes (a cluster holding a third of the points costs the same),
and the driver receives K rows. The plan is rebuilt from the cached relation
every iteration, so lineage never grows; a lost executor only re-reads its
own cached blocks from the scan.

Stopping rule: after each iteration the total squared movement of all
centres is compared with ``tol``; the loop stops once it is ``<= tol`` (at
least one iteration, centres replaced on the last pass too) or after
``max_iter`` iterations, if that is given. An empty cluster keeps its previous centre.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import count, zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.functions.vector import nearest, sq_distance
from orbitfit.operators.blocks import assign_blocks, lloyd_step_blocks
from orbitfit.operators.bounds import BoundedSteps
from orbitfit.operators.points import Features, project_array, project_points
from orbitfit.operators.sampling import sample_by_hash
from orbitfit.operators.seeding import kmeanspp_init, random_init
from orbitfit.operators.settled import SettledSteps
from orbitfit.session import dematerialize, materialize, spread

# Metric names of the timing summary, in the reference's order.
TIMING_METRICS = (
    "Iteration Time (total)",
    "Sampling Time",
    "Assignment Time",
    "Statistics Computation Time",
    "Inter-Cluster Distance Computation Time",
)


# Above this many centre coordinates (K * d) NumPy blocks replace the column
# expressions. Both add the same terms in the same order, so results are equal.
BLOCKS_ABOVE = 64
# From this many centres on, distance bounds are carried from one iteration to
# the next; the clusters stay the same.
BOUNDS_FROM = 64


def points_for(df: DataFrame, features: Features, keys: Sequence[str], invalid: str, k: int, method: str = "auto"
               ) -> tuple[DataFrame, list[str], list[str]]:
    """``(points, names, columns)``: an array that NumPy blocks will read stays one column, named as
    it is; other features become a column per dimension, ``names``."""
    if isinstance(features, str) and method != "expr":
        pts, names = project_array(df, features, keys, invalid)
        if method != "auto" or k * len(names) > BLOCKS_ABOVE:
            return pts, names, [features]
        pts, names = project_points(df, features, keys, invalid, len(names))
        return pts, names, names
    pts, names = project_points(df, features, keys, invalid)
    return pts, names, names


def _ms(t0: float) -> int:
    return int(round((time.perf_counter() - t0) * 1000))


def movement(old: Sequence[Sequence[float]], new: Sequence[Sequence[float]]) -> float:
    """Total squared movement of all centres."""
    total = 0.0
    for a, b in zip(old, new):
        s = 0.0
        for x, y in zip(a, b):
            s += (x - y) * (x - y)
        total += s
    return total


def lloyd_step(feats: DataFrame, names: Sequence[str], centres: Sequence[Sequence[float]]
               ) -> tuple[list[tuple[float, ...]], list[int]]:
    """One assignment + update pass; returns new centres and cluster sizes."""
    xs = [F.col(n) for n in names]
    cluster, _ = nearest(xs, centres)
    rows = (
        feats.select(cluster.alias("cluster"), *xs)
        .groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names])
        .collect()
    )
    by_id = {r["cluster"]: r for r in rows}
    new, sizes = [], []
    for i, c in enumerate(centres):
        r = by_id.get(i)
        if r is None or r["n"] == 0:
            new.append(tuple(c))
            sizes.append(0)
        else:
            n = r["n"]
            new.append(tuple(r[m] / n for m in names))
            sizes.append(int(n))
    return new, sizes


@dataclass
class KMeansModel:
    names: list[str]
    centres: list[tuple[float, ...]]
    init_centres: list[tuple[float, ...]]
    iterations: int
    converged: bool
    log: list[tuple[int, float, int, list[int]]] = field(default_factory=list)
    timings: dict[str, int] = field(default_factory=dict)
    distances: list[int] = field(default_factory=list)   # computed in each iteration, if they were counted
    passes: int = 0    # iterations that read all points

    @property
    def k(self) -> int:
        return len(self.centres)

    # -- tables ---------------------------------------------------------
    def centres_df(self, spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
        """Final centre table (K9/K11): ``cluster`` plus one column per dimension."""
        names = list(names or self.names)
        schema = T.StructType([T.StructField("cluster", T.IntegerType(), False)]
                              + [T.StructField(n, T.DoubleType(), False) for n in names])
        return spark.createDataFrame([(i, *c) for i, c in enumerate(self.centres)], schema)

    def iteration_log_df(self, spark: SparkSession) -> DataFrame:
        """Iteration log (K12): iteration from 1, movement, milliseconds."""
        schema = T.StructType([
            T.StructField("iteration", T.IntegerType(), False),
            T.StructField("movement", T.DoubleType(), False),
            T.StructField("time_ms", T.LongType(), False),
        ])
        return spark.createDataFrame([(i, m, ms) for i, m, ms, _ in self.log], schema)

    def timings_df(self, spark: SparkSession) -> DataFrame:
        """Timing summary (K13): metric, milliseconds."""
        schema = T.StructType([T.StructField("metric", T.StringType(), False),
                               T.StructField("time_ms", T.LongType(), False)])
        rows = [(m, int(self.timings.get(m, 0))) for m in TIMING_METRICS]
        return spark.createDataFrame(rows, schema)

    # -- distributed operators ------------------------------------------
    def assign(self, df: DataFrame, features: Features | None = None, keys: Sequence[str] = (),
               invalid: str = "error") -> DataFrame:
        """Every row with its cluster and squared distance (K10, P6). Lazy.

        The columns are the keys, the point (a column per dimension; a wide array
        stays one column), ``cluster`` and ``d2``.
        """
        pts, cols = self._points(df, features, keys, invalid)
        return self._tag(pts.select(*keys, *cols), cols)

    def _points(self, df: DataFrame, features: Features | None, keys: Sequence[str], invalid: str
                ) -> tuple[DataFrame, list[str]]:
        pts, _, cols = points_for(df, self.names if features is None else features, keys, invalid, self.k)
        return pts, cols

    def _tag(self, pts: DataFrame, names: Sequence[str]) -> DataFrame:
        """``pts`` with ``cluster`` and ``d2``."""
        if self.k * len(self.names) > BLOCKS_ABOVE:
            return assign_blocks(pts, names, self.centres)
        cluster, d2 = nearest([F.col(n) for n in names], self.centres)
        return pts.select("*", cluster.alias("cluster"), d2.alias("d2"))

    def cluster_stats(self, df: DataFrame, features: Features | None = None,
                      around: str = "centre", invalid: str = "error") -> DataFrame:
        """Per-cluster size and dispersion (K6 / K7), one aggregate, no gathering.

        ``around="centre"``: mean squared distance to the fitted centre.
        ``around="mean"``: mean point of the final assignment, and the mean
        squared distance to it, which equals ``sum_j var_pop(x_j)``.
        """
        assigned = self.assign(df, features, (), invalid)
        names = [c for c in assigned.columns if c not in ("cluster", "d2")]
        if around == "mean" and names != self.names and names == [features]:   # a wide array
            assigned = assigned.select("cluster", *[F.col(features)[j].alias(m) for j, m in enumerate(self.names)])
            names = self.names
        n = F.count(F.lit(1)).alias("number_of_points")
        if around == "centre":
            return assigned.groupBy("cluster").agg(n, F.avg("d2").alias("dispersion"))
        if around == "mean":
            parts = [F.var_pop(m) for m in names]
            while len(parts) > 1:     # in pairs: a chain of hundreds of sums is too deep to plan
                parts = [a if b is None else a + b for a, b in zip_longest(parts[::2], parts[1::2])]
            disp = parts[0]
            return assigned.groupBy("cluster").agg(
                n, *[F.avg(m).alias(f"centroid_{m}") for m in names], disp.alias("dispersion"))
        raise ValueError("around must be 'centre' or 'mean'")

    def inter_cluster_distances(self, spark: SparkSession) -> DataFrame:
        """Centre-to-centre distances for unordered pairs i < j.

        No join: each of the K centre rows explodes its partner ids ``j > i``
        and reads the partner's coordinates from literal arrays, so the plan
        is a narrow Generate over K rows.
        """
        dims = [f"_c{j}" for j in range(len(self.names))]
        c = self.centres_df(spark, dims)
        k = self.k
        partner = F.explode(F.filter(F.sequence(F.lit(0), F.lit(k - 1)),
                                     lambda j: j > F.col("cluster"))).alias("cluster_2")
        coord = [F.element_at(F.array(*[F.lit(float(ctr[m])) for ctr in self.centres]),
                              F.col("cluster_2") + 1) for m in range(len(dims))]
        d2 = sq_distance([F.col(m) for m in dims], coord)
        return (c.select("cluster", *dims, partner)
                .select(F.col("cluster").alias("cluster_1"), "cluster_2", F.sqrt(d2).alias("distance")))

    def sample_assignments(self, df: DataFrame, keys: Sequence[str], n: int = 10, seed: int = 42,
                           features: Features | None = None, invalid: str = "error") -> DataFrame:
        """A seeded n-point sample with its clusters (K5, L2)."""
        pts, names = self._points(df, features, keys, invalid)
        smp = sample_by_hash(pts, keys, n, seed, tie_cols=names)
        return self._tag(smp.select(*keys, *names), names).select(*keys, *names, "cluster")

    def report(self, df: DataFrame, keys: Sequence[str], features: Features | None = None,
               n_sample: int = 10, seed: int = 42, around: str = "centre",
               invalid: str = "error") -> dict[str, DataFrame]:
        """The reference's cluster report, timed; bounded results only."""
        spark = df.sparkSession
        t0 = time.perf_counter()
        pts, names = self._points(df, features, keys, invalid)
        picked = sample_by_hash(pts, keys, n_sample, seed, tie_cols=names).select(*keys, *names)
        smp = spark.createDataFrame(picked.collect(), picked.schema)   # n_sample rows
        self.timings[TIMING_METRICS[1]] = _ms(t0)
        t0 = time.perf_counter()
        tagged = self._tag(smp, names).select(*keys, *names, "cluster")
        sample = spark.createDataFrame(tagged.collect(), tagged.schema)
        self.timings[TIMING_METRICS[2]] = _ms(t0)
        t0 = time.perf_counter()
        stats = self.cluster_stats(df, features, around, invalid).collect()
        self.timings[TIMING_METRICS[3]] = _ms(t0)
        t0 = time.perf_counter()
        icd = self.inter_cluster_distances(spark).collect()
        self.timings[TIMING_METRICS[4]] = _ms(t0)
        return {
            "centres": self.centres_df(spark),
            "iteration_log": self.iteration_log_df(spark),
            "sample_assignments": sample,
            "cluster_stats": spark.createDataFrame(stats),
            "inter_cluster_distances": spark.createDataFrame(icd),
            "timings": self.timings_df(spark),
        }

    def register_views(self, df: DataFrame, keys: Sequence[str] = (), prefix: str = "",
                       features: Features | None = None, invalid: str = "error") -> None:
        """Temp views ``cluster_assignments`` and ``centroids``.

        Pass ``features`` and ``invalid`` as for the fit when it used an array
        or vector column, expressions, or dropped incomplete rows.
        """
        spark = df.sparkSession
        self.assign(df, features, keys, invalid).createOrReplaceTempView(f"{prefix}cluster_assignments")
        self.centres_df(spark).createOrReplaceTempView(f"{prefix}centroids")


def kmeans_fit(df: DataFrame, features: Features, k: int, keys: Sequence[str] = (),
               init: str | Sequence[Sequence[float]] = "random", tol: float = 0.1,
               max_iter: int | None = 100, seed: int = 42, invalid: str = "error",
               cache: str = "persist", method: str = "auto",
               spread_input: bool = False) -> KMeansModel:
    """Fit K centres by Lloyd iterations.

    ``init``: ``"random"`` (seeded K-point sample; needs ``keys``),
    ``"k-means++"`` (distance-squared seeding; needs ``keys``) or an explicit
    list of K centres. ``keys`` must identify rows (the seeded uniforms are
    hashed from them). ``max_iter``: None iterates until the fit has converged.
    ``method``: ``"expr"`` (literal-centre column
    expressions, whole-stage codegen), ``"blocks"`` (NumPy distance blocks in
    ``mapInArrow``), ``"bounds"`` (blocks that carry distance bounds, see
    :mod:`orbitfit.operators.bounds`), ``"settled"`` (blocks, and iterations over the
    points that can change only, see :mod:`orbitfit.operators.settled`) or ``"auto"`` (bounds from ``BOUNDS_FROM``
    centres on, else blocks once ``K * d`` exceeds ``BLOCKS_ABOVE``, which are settled ones if
    ``max_iter`` is None). ``spread_input``: round-robin a file scan with fewer
    splits than cores over all cores before caching (see ``session.spread``).
    """
    if method not in ("auto", "expr", "blocks", "bounds", "settled"):
        raise ValueError(f"unknown method {method!r}")
    pts, names, cols = points_for(df, features, keys, invalid, k, method)
    seeded = isinstance(init, str)
    # An under-split file scan (fewer splits than cores) may be spread over
    # the cores once, on request. Its partitions are fewer than the cores, so
    # the spread copy is kept (one scan, one round-robin shuffle); an input
    # with enough splits is used as it is.
    src = pts
    spread_copy = None
    if spread_input:
        spread_src = spread(pts)
        if spread_src is not pts:
            spread_copy = src = materialize(spread_src, cache)
    # The loop reads the features only, so only they are cached for it. A
    # random start is one pass over the keyed source (no keyed cache);
    # distance-squared seeding makes K passes, so it reads a cached keyed copy.
    # Keyed copies are released after the first iteration.
    base = None

    released = False

    def release() -> None:
        nonlocal released
        for keyed in (base, spread_copy):
            if keyed is not None and not released and not (keyed is base and base is spread_copy):
                dematerialize(keyed, cache)
        released = True

    t0 = time.perf_counter()
    if seeded:
        if not keys:
            raise ValueError("seeded initialisation needs key columns identifying the rows")
        if init not in ("random", "k-means++", "kmeans++", "kmeanspp"):
            release()
            raise ValueError(f"unknown init {init!r}")
        try:
            if init == "random":
                start = random_init(src, keys, cols, k, seed)
            else:
                base = src if spread_copy is not None else materialize(src, cache)
                start = kmeanspp_init(base, keys, cols, k, seed, cache="none")
        except Exception:
            release()
            raise
    else:
        start = [tuple(float(v) for v in c) for c in init]
        if len(start) != k:
            raise ValueError(f"{len(start)} start centres given for K={k}")
        if any(len(c) != len(names) for c in start):
            raise ValueError("start centre dimension does not match the features")
    init_ms = _ms(t0)

    if method == "auto":
        wide = "blocks" if max_iter is not None else "settled"
        method = "bounds" if k >= BOUNDS_FROM else wide if k * len(names) > BLOCKS_ABOVE else "expr"
    feats = (base if base is not None else src).select(*cols)
    steps = (BoundedSteps(feats, cols) if method == "bounds" else
             SettledSteps(feats, cols, cache) if method == "settled" else None)
    if steps is None:
        feats = materialize(feats, cache)
    plain = lloyd_step_blocks if method == "blocks" else lloyd_step
    centres = list(start)
    log: list[tuple[int, float, int, list[int]]] = []
    converged = False
    total_ms = 0
    try:
        for it in count(1) if max_iter is None else range(1, max_iter + 1):
            t0 = time.perf_counter()
            new, sizes = steps(centres) if steps else plain(feats, cols, centres)
            if it == 1:
                if sum(sizes) < k:
                    raise ValueError(f"K={k} is larger than the number of points ({sum(sizes)})")
                release()
            mv = movement(centres, new)
            centres = new
            ms = _ms(t0)
            total_ms += ms
            log.append((it, mv, ms, sizes))
            if mv <= tol:
                converged = True
                break
    finally:
        if steps:
            steps.release()
        else:
            dematerialize(feats, cache)
        release()
    model = KMeansModel(names=list(names), centres=centres, init_centres=list(start),
                        iterations=len(log), converged=converged, log=log)
    model.timings[TIMING_METRICS[0]] = total_ms
    model.timings["Initialisation Time"] = init_ms
    model.distances = steps.distances if method == "bounds" else []
    model.passes = steps.passes if method == "settled" else len(log)
    return model
