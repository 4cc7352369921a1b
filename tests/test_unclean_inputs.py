"""Inputs that are not clean: ragged arrays, NULL and NaN, odd CSV headers, empty draws, null keys."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.functions.random import hash_uniform
from orbitfit.functions.vector import array_add, array_dot, array_scale, array_subtract
from orbitfit.operators import kmeans
from orbitfit.operators.blocks import assign_blocks
from orbitfit.operators.kmeans import KMeansModel, kmeans_fit
from orbitfit.operators.linear import normal_stats, standardize
from orbitfit.operators.prefix import threshold_draw
from orbitfit.sources.csv import read_csv_stable
from orbitfit.sources.tables import line_dataset


def model(names, centres):
    return KMeansModel(names=names, centres=centres, init_centres=centres, iterations=0, converged=True)


def test_ragged_arrays_are_not_cut(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0, 500.0]), (3, [9.0, 9.0])], "id int, v array<double>")
    with pytest.raises(ValueError, match="2 to 3"):
        kmeans_fit(df, "v", 2, init=[(0, 0), (9, 9)])
    m = model(["v_0", "v_1"], [(0.0, 0.0), (9.0, 9.0)])
    clean = df.filter("id <> 2")
    assert [r["cluster"] for r in m.assign(clean, "v", ["id"]).orderBy("id").collect()] == [0, 1]


def test_block_and_expression_paths_agree_to_the_bit(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (4000, 8)) / 100.0
    names = [f"x{j}" for j in range(8)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["id", *names])
    m = model(names, [tuple(map(float, c)) for c in rng.integers(-500, 500, (9, 8)) / 100.0])
    wide = {r["id"]: (r["cluster"], r["d2"]) for r in assign_blocks(df, names, m.centres).collect()}
    monkeypatch.setattr(kmeans, "BLOCKS_ABOVE", 10**9)
    narrow = {r["id"]: (r["cluster"], r["d2"]) for r in m.assign(df, keys=["id"]).collect()}
    assert wide == narrow
    sample = m.sample_assignments(df, ["id"], 50).collect()
    assert all(narrow[r["id"]][0] == r["cluster"] for r in sample)
    report = m.report(df, ["id"], n_sample=50)["sample_assignments"].collect()
    assert {(r["id"], r["cluster"]) for r in report} == {(r["id"], r["cluster"]) for r in sample}


def test_views_of_an_array_model(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [9.0, 9.0]), (3, [None, 1.0])], "id int, v array<double>")
    m = kmeans_fit(df, "v", 2, init=[(0, 0), (9, 9)], invalid="skip")
    m.register_views(df, ["id"], prefix="ragged_", features="v", invalid="skip")
    assert [tuple(r) for r in spark.sql("select id, cluster from ragged_cluster_assignments order by id").collect()] == [(1, 0), (2, 1)]


def test_failed_seeding_releases_its_copies(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(5)], "id int, a double, b double")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(Exception):
        kmeans_fit(df, ["a", "b"], 4, keys=["id"], init="k-means++")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_null_and_nan_in_linear_statistics(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0,), (2.0,), (nan,)], "x double")
    assert all(math.isnan(r["x"]) for r in standardize(df, ["x"])[0].collect())
    flat = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [r["x"] for r in standardize(flat, ["x"])[0].collect()] == [0.0, 0.0, None]
    line = spark.createDataFrame([(3.0, 1.0, 1.0), (4.0, 2.0, 1.0), (None, 3.0, 1.0)], "y double, x double, one double")
    with pytest.raises(Exception, match="NULL or NaN"):
        normal_stats(line, "y", ["x", "one"])
    stats = normal_stats(line, "y", ["x", "one"], invalid="skip")
    assert stats.n == 2 and stats.loss([1.0, 2.0]) == pytest.approx(0.0, abs=1e-12)


SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_csv_headers_of_each_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text("\na,b\n1,x\na,b\n2,y\n")
    (tmp_path / "two.csv").write_text('A,B\n3,"x,y"\nbad,z\n\n4,w\n')
    rows = read_csv_stable(spark, str(tmp_path), SCHEMA, timestamp_format=None).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, "y"), (3, "x,y"), (4, "w")]


def test_csv_keeps_a_row_that_equals_the_header(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,x\na,b\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = read_csv_stable(spark, str(tmp_path), schema, timestamp_format=None).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "x"), ("a", "b")]


def test_a_draw_without_weight_has_no_row(spark):
    cum = spark.createDataFrame([(1, 0.5, 0.0, 0.0)], "id int, u double, w double, cum_through double")
    assert threshold_draw(cum, "w", "u", ["id"], 0.5).collect() == []
    assert threshold_draw(cum.limit(0), "w", "u", ["id"], 0.5).collect() == []


@pytest.mark.parametrize("n,shards", [(1005, 10), (3, 10), (1000, 10)])
def test_line_shards(spark, n, shards):
    got = [r["shard"] for r in line_dataset(spark, n, shards).orderBy("seq").collect()]
    assert got == [i * shards // n for i in range(n)]


def test_null_keys_draw_differently(spark):
    df = spark.createDataFrame([(None, "1"), ("1", None), ("a:", "b"), ("a", ":b")], "a string, b string")
    assert len({r[0] for r in df.select(hash_uniform(["a", "b"], 7)).collect()}) == 4


def test_array_arithmetic(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 5.0])], "p array<double>, q array<double>")
    p, q = F.col("p"), F.col("q")
    r = df.select(array_add(p, q).alias("s"), array_subtract(p, q).alias("d"), array_scale(2, p).alias("m"),
                  array_dot(p, q).alias("x")).first()
    assert (r["s"], r["d"], r["m"], r["x"]) == ([4.0, 7.0], [-2.0, -3.0], [2.0, 4.0], 13.0)
