import math

import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_MED, SF_SMALL
from orbitfit.functions.random import hash_uniform, hash_uniform_sql
from orbitfit.functions.vector import nearest_centre
from orbitfit.operators.kmeans import KMeansModel, kmeans_fit, movement
from orbitfit.sources.tables import LINEITEM_KEYS, lineitem_points

START = [(5, 1), (15, 8), (25, 3), (35, 9), (45, 5)]

# Golden values (FIXTURES F7): three iterations from START at sf0.01.
GOLDEN_3 = [(5.426645, 4.901323), (15.07728, 5.245578), (24.97191, 4.698508),
            (35.019584, 5.225706), (45.308098, 4.894302)]
GOLDEN_SIZES_1 = [11140, 12143, 13094, 10266, 13357]


def _df1(spark, xs):
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id long, x double")


def test_golden_three_iterations(spark):
    df = lineitem_points(spark, SF_MED)
    m = kmeans_fit(df, ["x", "y"], 5, keys=LINEITEM_KEYS, init=START, tol=-1, max_iter=3)
    assert m.log[0][3] == GOLDEN_SIZES_1
    for got, want in zip(m.centres, GOLDEN_3):
        assert got[0] == pytest.approx(want[0], abs=1e-6)
        assert got[1] == pytest.approx(want[1], abs=1e-6)
    assert not m.converged and m.iterations == 3


def test_tie_goes_to_lowest_index(spark):
    df = _df1(spark, [5.0])
    a = df.select(nearest_centre([F.col("x")], [(4.0,), (6.0,)]).alias("a")).collect()[0]["a"]
    assert a["cluster"] == 0 and a["d2"] == 1.0


def test_duplicate_start_centres_keep_empty_cluster(spark):
    df = _df1(spark, [1, 2, 3, 28, 30, 32])
    m = kmeans_fit(df, ["x"], 3, init=[(5.0,), (5.0,), (30.0,)], tol=0.0, max_iter=5)
    assert m.log[0][3][1] == 0
    assert m.centres[1] == (5.0,)  # empty cluster keeps its centre
    assert m.centres[0] == (2.0,) and m.centres[2] == (30.0,)


def test_k_larger_than_rows_errors(spark):
    df = _df1(spark, [1, 2, 3])
    with pytest.raises(ValueError):
        kmeans_fit(df, ["x"], 5, keys=["id"], init="random")


def test_null_and_nan_policy(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, float("nan")), (3, 9.0)], "id long, x double")
    with pytest.raises(Exception):
        kmeans_fit(df, ["x"], 2, init=[(0.0,), (10.0,)], max_iter=1)
    m = kmeans_fit(df, ["x"], 2, init=[(0.0,), (10.0,)], max_iter=2, invalid="skip")
    assert sum(m.log[0][3]) == 2
    assigned = m.assign(df, keys=["id"], invalid="skip").collect()
    assert sorted(r["id"] for r in assigned) == [0, 3]


def test_convergence_and_invariants(spark):
    df = lineitem_points(spark, SF_SMALL)
    n = df.count()
    m = kmeans_fit(df, ["x", "y"], 5, keys=LINEITEM_KEYS, init="random", tol=0.1, max_iter=50)
    assert m.converged and m.log[-1][1] <= 0.1
    assert all(mv > 0.1 for _, mv, _, _ in m.log[:-1])
    assert all(sum(s) == n for *_, s in m.log)
    # within-cluster cost never rises between iterations
    costs = []
    for i in range(len(m.log)):
        sub = kmeans_fit(df, ["x", "y"], 5, keys=LINEITEM_KEYS, init="random", tol=-1, max_iter=i + 1)
        model = KMeansModel(["x", "y"], sub.centres, sub.centres, 0, False)
        costs.append(model.assign(df).agg(F.sum("d2")).collect()[0][0])
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_result_independent_of_partitioning(spark):
    df = lineitem_points(spark, SF_SMALL)
    a = kmeans_fit(df, ["x", "y"], 5, keys=LINEITEM_KEYS, init="k-means++", max_iter=20)
    b = kmeans_fit(df.repartition(7), ["x", "y"], 5, keys=LINEITEM_KEYS, init="k-means++", max_iter=20)
    assert a.init_centres == b.init_centres
    for p, q in zip(a.centres, b.centres):
        assert p == pytest.approx(q, abs=1e-9)


def test_blocks_path_matches_expression_path(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    a = kmeans_fit(df, "embedding", 4, keys=["vec_id"], init="random", tol=-1, max_iter=2, method="expr")
    b = kmeans_fit(df, "embedding", 4, keys=["vec_id"], init="random", tol=-1, max_iter=2, method="blocks")
    assert [s for *_, s in a.log] == [s for *_, s in b.log]
    for p, q in zip(a.centres, b.centres):
        assert p == pytest.approx(q, abs=1e-12)


def test_cluster_stats_and_distances(spark):
    df = lineitem_points(spark, SF_SMALL)
    m = kmeans_fit(df, ["x", "y"], 3, keys=LINEITEM_KEYS, init=START[:3], tol=-1, max_iter=2)
    mean = {r["cluster"]: r for r in m.cluster_stats(df, around="mean").collect()}
    pts = m.assign(df).collect()
    for c, r in mean.items():
        rows = [(p["x"], p["y"]) for p in pts if p["cluster"] == c]
        mx = sum(x for x, _ in rows) / len(rows)
        my = sum(y for _, y in rows) / len(rows)
        disp = sum((x - mx) ** 2 + (y - my) ** 2 for x, y in rows) / len(rows)
        assert r["number_of_points"] == len(rows)
        assert r["centroid_x"] == pytest.approx(mx) and r["dispersion"] == pytest.approx(disp)
    centre = {r["cluster"]: r for r in m.cluster_stats(df, around="centre").collect()}
    for c, r in centre.items():
        d = [p["d2"] for p in pts if p["cluster"] == c]
        assert r["dispersion"] == pytest.approx(sum(d) / len(d))
    icd = m.inter_cluster_distances(spark).collect()
    assert len(icd) == 3
    for r in icd:
        a, b = m.centres[r["cluster_1"]], m.centres[r["cluster_2"]]
        assert r["cluster_1"] < r["cluster_2"]
        assert r["distance"] == pytest.approx(math.dist(a, b))


def test_report_and_views(spark):
    df = lineitem_points(spark, SF_SMALL)
    m = kmeans_fit(df, ["x", "y"], 5, keys=LINEITEM_KEYS, init="random", max_iter=30)
    rep = m.report(df, LINEITEM_KEYS)
    assert rep["sample_assignments"].count() == 10
    assert rep["timings"].count() == 5
    assert rep["iteration_log"].count() == m.iterations
    m.register_views(df, keys=LINEITEM_KEYS, prefix="t_")
    assert spark.table("t_centroids").count() == 5
    assert spark.table("t_cluster_assignments").count() == df.count()


def test_movement_is_total_squared_shift():
    assert movement([(0.0, 0.0), (1.0, 1.0)], [(3.0, 4.0), (1.0, 2.0)]) == 26.0


def test_hash_uniform_matches_sql(spark):
    import duckdb
    rows = [(1, 2), (123456789012, 7), (0, 0)]
    df = spark.createDataFrame(rows, "a long, b int")
    got = [r[0] for r in df.select(hash_uniform(["a", "b"], 42, 3)).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT {hash_uniform_sql(['a', 'b'], 42, 3)} FROM (SELECT {a}::BIGINT AS a, "
                        f"{b}::INTEGER AS b)").fetchone()[0] for a, b in rows]
    assert got == want
    assert all(0.0 < u < 1.0 for u in got)


def test_wide_assignment_uses_blocks_and_matches_expressions(spark):
    from orbitfit.functions.vector import nearest
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    m = kmeans_fit(df, "embedding", 10, keys=["vec_id"], init="random", tol=-1, max_iter=1)
    got = {r["vec_id"]: (r["cluster"], r["d2"]) for r in m.assign(df, "embedding", keys=["vec_id"]).collect()}
    pts = df.select("vec_id", *[F.col("embedding")[j].cast("double").alias(f"embedding_{j}") for j in range(64)])
    c, d2 = nearest([F.col(f"embedding_{j}") for j in range(64)], m.centres)
    want = {r["vec_id"]: (r["c"], r["d2"]) for r in pts.select("vec_id", c.alias("c"), d2.alias("d2")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1], rel=1e-12)


def test_checkpoint_mode_uses_shared_folder(spark):
    df = lineitem_points(spark, SF_SMALL)
    a = kmeans_fit(df, ["x", "y"], 5, keys=LINEITEM_KEYS, init="random", max_iter=5, cache="checkpoint")
    b = kmeans_fit(df, ["x", "y"], 5, keys=LINEITEM_KEYS, init="random", max_iter=5)
    assert a.centres == b.centres


def test_ml_vector_features_dense_and_sparse(spark):
    """An ML vector column (dense or sparse rows mixed) gives the same points
    and the same fit as the plain columns (P3, P4)."""
    from pyspark.ml.linalg import Vectors
    from orbitfit.operators.points import project_points
    rows = [(i, float(i % 9), float((i * 7) % 5)) for i in range(200)]
    vec = [(i, Vectors.sparse(2, {j: v for j, v in enumerate((x, y)) if v != 0.0}) if i % 2
            else Vectors.dense([x, y])) for i, x, y in rows]
    cols = spark.createDataFrame(rows, "id long, x double, y double")
    vdf = spark.createDataFrame(vec, ["id", "features"])
    pv, names = project_points(vdf, "features", ["id"])
    assert names == ["features_0", "features_1"]
    got = sorted(tuple(r) for r in pv.collect())
    assert got == sorted(rows)
    start = [(1.0, 1.0), (7.0, 3.0)]
    a = kmeans_fit(cols, ["x", "y"], 2, init=start, tol=-1, max_iter=3)
    b = kmeans_fit(vdf, "features", 2, init=start, tol=-1, max_iter=3)
    assert a.centres == b.centres


def test_spread_sizes_from_rows(spark, monkeypatch):
    """An under-split input is spread to at most one partition per
    MIN_ROWS_PER_TASK rows (capped at the cores); a tiny one stays whole and
    an input with enough splits is returned as it is."""
    from orbitfit import session
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, 1, 1)
    assert session.spread(one) is one                       # 1000 rows < 10k: one task
    monkeypatch.setattr(session, "MIN_ROWS_PER_TASK", 400)
    assert session.spread(one).rdd.getNumPartitions() == min(cores, 3)
    many = spark.range(0, 1000, 1, cores)
    assert session.spread(many) is many


def test_fit_on_derived_input_with_and_without_cache(spark):
    """A fit on an aggregated (shuffled) input: the same centres whether the
    features are persisted or recomputed from the plan each iteration, up to
    rounding (a recomputed average may add its rows in another order, since
    a shuffle read has no fixed order)."""
    li = lineitem_points(spark, SF_SMALL)
    per_order = li.groupBy("l_orderkey").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    a = kmeans_fit(per_order, ["x", "y"], 3, keys=["l_orderkey"], init="random", max_iter=5)
    b = kmeans_fit(per_order, ["x", "y"], 3, keys=["l_orderkey"], init="random", max_iter=5,
                   cache="none")
    assert a.iterations == b.iterations
    for ca, cb in zip(a.centres, b.centres):
        assert ca == pytest.approx(cb, rel=1e-12)
