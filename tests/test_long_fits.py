"""Fits that need many iterations, and the blocks that carry distance bounds."""

import numpy as np

from orbitfit.operators.bounds import BoundedSteps
from orbitfit.plans.kmeans_plans import EMB_MAX_ITER, kmeans_embeddings_fit


def test_embeddings_fit_goes_on_until_it_converges(spark, tmp_path):
    x = np.random.default_rng(5).uniform(size=1000)
    rows = spark.createDataFrame([(i, [float(v)]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = kmeans_embeddings_fit(spark, str(tmp_path)).collect()
    centres = np.array([r["value"] for r in sorted(got, key=lambda r: r["cluster"])])
    near = np.abs(x[:, None] - centres).argmin(axis=1)
    assert got[0]["iterations"] > EMB_MAX_ITER
    assert np.allclose([x[near == c].mean() for c in range(10)], centres, atol=1e-5)


def test_bounded_steps_keep_blocks_of_points(spark):
    n, start = 30_000, [(float(i), 1.0) for i in range(6)]
    feats = spark.range(0, n, 1, 2).selectExpr("cast(id % 11 as double) AS x", "cast(id % 7 as double) AS y")
    steps = BoundedSteps(feats, ["x", "y"])
    try:
        centres, sizes = steps(start)
        again, sizes = steps(centres)
        assert sum(sizes) == n and steps.distances[0] == 6 * n
        assert steps.state.count() < n / 100
    finally:
        steps.release()
