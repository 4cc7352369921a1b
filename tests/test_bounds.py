"""Wide points in one array column, and Lloyd steps with carried distance bounds."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitfit.operators import bounds
from orbitfit.operators.bounds import reassign
from orbitfit.operators.kmeans import kmeans_fit, points_for
from orbitfit.operators.seeding import kmeanspp_init
from orbitfit.sources.tables import LINEITEM_KEYS, table
from sf_dirs import SF_MED, SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_points_stay_one_column(spark):
    wide = spark.range(60).select("id", F.transform(F.sequence(F.lit(1), F.lit(384)),
                                                    lambda j: F.sin(F.col("id") * j)).alias("v"))
    points_for(wide, "v", ["id"], "error", 10)      # the first query of a session also loads classes
    t = time.perf_counter()
    pts, names, cols = points_for(wide, "v", ["id"], "error", 10)
    plan = _plan(pts)
    assert time.perf_counter() - t < 2.0
    assert cols == ["v"] and len(names) == 384 and "v_1" not in plan
    assert plan.count("raise_error") <= 1
    m = kmeans_fit(wide, "v", 3, keys=["id"], tol=1e-9, max_iter=50)
    x = np.array([r["v"] for r in wide.collect()])
    assert m.converged
    near = ((x[:, None, :] - np.array(m.centres)[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert np.allclose([x[near == i].mean(axis=0) for i in range(3)], m.centres, atol=1e-12)
    stats = {r["cluster"]: r for r in m.cluster_stats(wide, "v", around="mean").collect()}
    assert [stats[i]["number_of_points"] for i in range(3)] == np.bincount(near, minlength=3).tolist()
    assert stats[1]["centroid_v_7"] == pytest.approx(m.centres[1][7], abs=1e-12)
    sample = m.sample_assignments(wide, ["id"], 5, features="v").collect()
    assert all(near[r["id"]] == r["cluster"] for r in sample)


def test_wide_seeding_equals_the_column_form(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    cols = emb.select("vec_id", *[F.col("e")[j].alias(f"e_{j}") for j in range(64)])
    assert kmeanspp_init(emb, ["vec_id"], ["e"], 4, 7) == kmeanspp_init(cols, ["vec_id"], [f"e_{j}" for j in range(64)], 4, 7)


@pytest.mark.parametrize("bad", [None, [1.0] * 63, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63])
def test_wide_points_follow_the_null_policy(spark, bad):
    rows = [(i, [float(i * j % 7) for j in range(64)]) for i in range(30)]
    df = spark.createDataFrame([*rows, (99, bad)], "id long, v array<double>")
    start = [tuple(r[1]) for r in rows[1:4]]
    if bad is not None and len(bad) == 63:
        with pytest.raises(ValueError, match="63 to 64"):
            kmeans_fit(df, "v", 3, init=start, max_iter=1)
        return
    with pytest.raises(Exception, match="NULL or NaN"):
        kmeans_fit(df, "v", 3, init=start, max_iter=1)
    m = kmeans_fit(df, "v", 3, init=start, max_iter=1, invalid="skip")
    assert sum(m.log[0][3]) == 30


@pytest.mark.parametrize("k,d", [(1, 2), (2, 1), (7, 2), (40, 5)])
def test_bounds_never_change_a_cluster(k, d):
    """Random walks of the centres, with ties and repeated centres, against the full comparison."""
    rng = np.random.default_rng(k)
    X = rng.integers(-20, 20, (500, d)) / 4.0
    C = rng.integers(-20, 20, (k, d)) / 4.0
    C[-1] = C[0]
    cluster = lower = moved = None
    for step in range(12):
        cluster, lower, tried = reassign(X, C, cluster, lower, moved)
        d2 = bounds.squared(X, C)
        assert (cluster == d2.argmin(axis=1)).all()
        assert tried.max() <= k + 1 and (step or (tried == k).all())
        others = np.sqrt(np.where(np.arange(k) == cluster[:, None], np.inf, d2).min(axis=1))
        assert (lower <= others).all()
        new = C + rng.normal(size=C.shape) * 0.3 ** step
        moved, C = np.sqrt(((new - C) ** 2).sum(axis=1)), new


def test_many_centres_compute_few_distances(spark, monkeypatch):
    """K = 200 over lineitem: clusters, sizes and centres of the plain blocks, under half the distances."""
    monkeypatch.setattr(bounds, "CUT_EVERY", 4)
    pts = table(spark, SF_MED, "lineitem").select(*LINEITEM_KEYS, (F.col("l_extendedprice") / 1000).alias("x"),
                                                  F.col("l_quantity").alias("y"))
    args = dict(keys=LINEITEM_KEYS, tol=-1.0, max_iter=9)
    plain = kmeans_fit(pts, ["x", "y"], 200, method="blocks", **args)
    fit = kmeans_fit(pts, ["x", "y"], 200, method="bounds", **args)
    assert [s for *_, s in fit.log] == [s for *_, s in plain.log]
    assert fit.centres == plain.centres
    n = sum(fit.log[0][3])
    assert fit.distances[0] == 200 * n and sum(fit.distances) < 0.5 * 200 * n * 9


def test_bounds_release_their_copies(spark):
    df = spark.createDataFrame([(float(i % 11), float(i % 7)) for i in range(300)], "x double, y double")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    start = [(float(i), 1.0) for i in range(6)]
    m = kmeans_fit(df, ["x", "y"], 6, init=start, tol=1e-9, method="bounds")
    assert m.centres == kmeans_fit(df, ["x", "y"], 6, init=start, tol=1e-9, method="blocks").centres
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    with pytest.raises(ValueError, match="larger than the number"):
        kmeans_fit(df.limit(3), ["x", "y"], 6, init=start, method="bounds")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    with pytest.raises(ValueError, match="unknown method"):
        kmeans_fit(df, ["x", "y"], 6, init=start, method="bound")
