import numpy as np
import pytest

from sf_dirs import SF_SMALL
from orbitfit.operators.linear import (
    column_moments, full_batch_history, gradient, mse, normal_stats, standardize,
)
from orbitfit.sources.tables import line_dataset, table


def test_moments_match_numpy(spark):
    li = table(spark, SF_SMALL, "lineitem")
    cols = ["l_quantity", "l_discount"]
    got = {r["column"]: r for r in column_moments(li, cols).collect()}
    data = li.select(*cols).toPandas()
    for c in cols:
        assert got[c]["n"] == len(data)
        assert got[c]["mean"] == pytest.approx(data[c].mean())
        assert got[c]["stddev"] == pytest.approx(data[c].std(ddof=0))


def test_standardize_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0), (5.0, 1.0)], "a double, b double")
    s, means, sds = standardize(df, ["a", "b"])
    rows = s.collect()
    assert [r["b"] for r in rows] == [0.0, 0.0, 0.0]
    assert sorted(r["a"] for r in rows) == pytest.approx([-np.sqrt(1.5), 0.0, np.sqrt(1.5)])
    assert means == [3.0, 1.0] and sds[1] == 0.0


def test_normal_stats_loss_and_gradient(spark):
    line = line_dataset(spark)
    st = normal_stats(line, "y", ["x", "bias"])
    w = [0.7, 3.0]
    direct = line.agg(mse(line, "y", ["x", "bias"], w)).collect()[0][0]
    assert st.loss(w) == pytest.approx(direct, rel=1e-9)
    g = line.agg(*gradient(line, "y", ["x", "bias"], w)).collect()[0]
    assert list(g) == pytest.approx(st.grad(w), rel=1e-9)
    # gradient equals a finite difference of the loss
    h = 1e-6
    for j in range(2):
        wp, wm = list(w), list(w)
        wp[j] += h
        wm[j] -= h
        fd = (st.loss(wp) - st.loss(wm)) / (2 * h)
        assert fd == pytest.approx(st.grad(w)[j], rel=1e-4)


def test_full_batch_gd_reaches_normal_equations(spark):
    line = line_dataset(spark)
    s, _, _ = standardize(line, ["x"], keep=["y", "bias"])
    st = normal_stats(s, "y", ["x", "bias"])
    exact = np.linalg.solve(np.array(st.xtx), np.array(st.xty))
    for method in ("gd", "heavy_ball", "nesterov"):
        h = full_batch_history(st, method, 300, 0.2, 0.0, 0.6)
        assert [h[-1][2], h[-1][3]] == pytest.approx(list(exact), rel=1e-6)
        assert h[-1][-1] == pytest.approx(0.0, abs=1e-6)


def test_array_helpers_require_equal_length(spark):
    import pytest as _pytest
    from pyspark.sql import functions as F
    from orbitfit.functions.vector import array_add, array_dot
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0])], "a array<double>, b array<double>")
    r = df.select(array_add(F.col("a"), F.col("b")).alias("s"), array_dot(F.col("a"), F.col("b")).alias("d")).collect()[0]
    assert list(r["s"]) == [4.0, 6.0] and r["d"] == 11.0
    bad = spark.createDataFrame([([1.0, 2.0], [3.0])], "a array<double>, b array<double>")
    with _pytest.raises(Exception, match="differ in length"):
        bad.select(array_dot(F.col("a"), F.col("b"))).collect()


@pytest.mark.parametrize("spread", [1.0, 1e4, 1e7])
def test_loss_of_a_good_fit_far_from_zero(spark, spread):
    """x around 1e7, residuals of 0.01: the loss from the statistics is that of a pass over the rows."""
    from pyspark.sql import functions as F
    df = spark.range(4000).select(
        (F.lit(1e7) + F.floor(spread * ((F.col("id") * 7919) % 4000) / 4)).alias("x"), F.lit(1.0).alias("bias"),
        (F.when(F.col("id") % 2 == 0, 0.01).otherwise(-0.01)).alias("noise"))
    df = df.withColumn("y", F.col("x") + 2 + F.col("noise"))
    st = normal_stats(df, "y", ["x", "bias"])
    for w in ([1.0, 2.0], [1.0, 2.5], [1.0 + 1e-9, 2.0], [0.0, 0.0], [3.0, -7.0], st.ref):
        direct = df.agg(mse(df, "y", ["x", "bias"], w)).first()[0]
        assert st.loss(w) >= 0.0
        assert st.loss(w) == pytest.approx(direct, rel=1e-9), w


def test_statistics_merge_over_any_partitioning(spark):
    line = line_dataset(spark, n=700, shards=7)
    one = normal_stats(line.coalesce(1), "y", ["x", "bias"])
    many = normal_stats(line.repartition(13), "y", ["x", "bias"])
    assert np.allclose(one.xtx, many.xtx, rtol=1e-13) and np.allclose(one.xty, many.xty, rtol=1e-13)
    assert one.n == many.n == 700
    x = np.array([[2.0 * i + 1, 1.0] for i in range(700)])
    assert np.allclose(one.xtx, x.T @ x, rtol=1e-13) and np.allclose(one.xty, x.T @ (x[:, 0] + 2), rtol=1e-13)


def test_statistics_of_degenerate_rows(spark):
    schema = "y double, a double, b double"
    with pytest.raises(ValueError, match="no rows"):
        normal_stats(spark.createDataFrame([], schema), "y", ["a", "b"])
    zeros = normal_stats(spark.createDataFrame([(0.0, 0.0, 0.0)] * 3, schema), "y", ["a", "b"])
    assert zeros.loss([1.0, 2.0]) == 0.0 and zeros.grad([1.0, 2.0]) == [0.0, 0.0]
    one = normal_stats(spark.createDataFrame([(5.0, 2.0, 0.0)], schema), "y", ["a", "b"])
    assert one.loss([2.0, 9.0]) == 1.0 and one.grad([2.0, 9.0]) == [-4.0, 0.0]
