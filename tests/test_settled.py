"""Long fits: iterations over the points that can still change their cluster."""

import numpy as np
import pytest

from orbitfit.operators import settled
from orbitfit.operators.blocks import nearest_block
from orbitfit.operators.kmeans import kmeans_fit
from orbitfit.operators.settled import SettledSteps, nearest_two, reach_of
from orbitfit.plans.kmeans_plans import kmeans_embeddings_fit


def points(n, d, seed=1):
    return np.random.default_rng(seed).normal(size=(n, d))


def frame(spark, X, parts=3):
    rows = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "vec_id long, embedding array<double>")
    return rows.repartition(parts, "vec_id")


def plain(X, centres):
    """A Lloyd step over all points."""
    cluster, _ = nearest_block(X, np.asarray(centres))
    sizes = np.bincount(cluster, minlength=len(centres))
    return [tuple(X[cluster == c].mean(axis=0)) if n else tuple(centres[c]) for c, n in enumerate(sizes)], [*sizes]


def test_embeddings_fit_runs_fewer_jobs_than_iterations(spark, tmp_path):
    frame(spark, points(3000, 12).astype(np.float32), 1).write.parquet(f"{tmp_path}/embeddings.parquet")
    sc = spark.sparkContext
    sc.setJobGroup("settled", "a fit to convergence")
    try:
        got = kmeans_embeddings_fit(spark, str(tmp_path)).collect()
        jobs = len(sc.statusTracker().getJobIdsForGroup("settled"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got[0]["iterations"] > 25 and len(got) == 120
    assert jobs < got[0]["iterations"]


@pytest.mark.parametrize("direct", [256, 0])
def test_steps_are_those_over_all_points(spark, monkeypatch, direct):
    """Random points, points that come twice and points on a grid, which tie: the same clusters in each iteration."""
    monkeypatch.setattr(settled, "DIRECT_TASKS", direct)
    X = np.concatenate([points(2000, 3), points(500, 3), points(500, 3), np.round(points(1000, 3, 2))])
    centres = want = [tuple(x) for x in np.round(X[:7], 1)]
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    steps = SettledSteps(frame(spark, X).select("embedding"), ["embedding"])
    rounds = 40 if direct else 12
    try:
        for _ in range(rounds):
            centres, sizes = steps(centres)
            want, expected = plain(X, want)
            assert sizes == expected
            assert np.allclose(centres, want, rtol=0, atol=1e-12)
        assert steps.passes < (0.8 * rounds if direct else rounds)
    finally:
        steps.release()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_points_in_one_block_are_handed_over_up_to_its_part(spark, monkeypatch):
    """All open points lie in one of the blocks: few are handed over, and the steps stay right."""
    monkeypatch.setattr(settled, "PACKED_VALUES", 400)
    monkeypatch.setattr(settled, "WORTH", 0.0)
    away = np.array([[-9.0, 0.0], [9.0, 0.0]]).repeat(1500, axis=0) + points(3000, 2)
    X = np.concatenate([away, points(200, 2) * 0.05])
    rows = spark.createDataFrame([([float(v) for v in x],) for x in X], "embedding array<double>").coalesce(1)
    steps = SettledSteps(rows, ["embedding"])
    centres = want = [(-8.0, 1.0), (8.0, 0.5)]
    try:
        for _ in range(5):
            centres, sizes = steps(centres)
            want, expected = plain(X, want)
            assert sizes == expected and np.allclose(centres, want, rtol=0, atol=1e-12)
        assert 0 < len(steps.X) <= 2 * len(X) / settled.OPEN_SHARE + 20
    finally:
        steps.release()


def test_no_point_is_open_if_there_is_one_centre(spark):
    X = points(200, 2)
    steps = SettledSteps(frame(spark, X).select("embedding"), ["embedding"])
    centres = [(5.0, 5.0)]
    try:
        for _ in range(4):
            centres, sizes = steps(centres)
            assert sizes == [200] and np.allclose(centres, X.mean(axis=0), rtol=0, atol=1e-12)
        assert steps.passes == 2 and len(steps.X) == 0
    finally:
        steps.release()


def test_single_and_double_precision_values_are_kept(spark):
    single, double = np.float32([[0.1, 0.2]]).astype(float), np.array([[0.1, 1e300]])
    for X, exact in ((single, True), (double, False)):
        data, kept = settled.packed(X)
        assert kept == exact
        assert (np.frombuffer(data, np.float32 if kept else float).reshape(X.shape) == X).all()


def test_values_that_are_not_finite_do_not_spoil_other_clusters(spark):
    X = points(300, 2)
    X[7, 0] = np.inf
    args = dict(k=3, init=[(-1.0, 0.0), (1.0, 0.0), (0.0, 1.0)], tol=-1.0, max_iter=3)
    a, b = (kmeans_fit(frame(spark, X), "embedding", method=m, **args) for m in ("blocks", "settled"))
    assert [s for *_, s in a.log] == [s for *_, s in b.log]
    assert np.allclose(a.centres, b.centres, equal_nan=True)


def test_clusters_are_those_of_the_plain_block_and_gaps_never_too_large():
    rng = np.random.default_rng(4)
    for offset in (0.0, 1e6, 1e9):
        X = np.concatenate([rng.normal(size=(400, 4)), rng.integers(-2, 3, (400, 4))]) + offset
        C = np.concatenate([X[:5], X[400:405], X[:1]])
        cluster, gap = nearest_two(X, C)
        assert (cluster == nearest_block(X, C)[0]).all()
        d = np.sqrt(((X[:, None] - C[None]) ** 2).sum(axis=2))
        own = d[np.arange(len(X)), cluster]
        d[np.arange(len(X)), cluster] = np.inf
        assert (gap <= np.maximum(d.min(axis=1) - own, 0)).all()
        assert offset or (gap > 0).mean() > 0.5


def test_reach_has_as_many_points_below_as_asked_for():
    gap = np.abs(points(10_000, 1)[:, 0])
    bins = np.bincount(settled.gap_bins(gap), minlength=1 - 2 * settled.LOWEST)
    for most in (100, 2500):
        assert (gap < reach_of(bins, most)).sum() == pytest.approx(most, rel=0.1)
    ties = np.bincount(settled.gap_bins(np.zeros(50)), minlength=1 - 2 * settled.LOWEST)
    assert reach_of(ties, 10) == 0
