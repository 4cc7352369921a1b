"""Physical-plan properties that the scale design relies on."""

from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from orbitfit.functions.random import hash_uniform
from orbitfit.functions.vector import nearest
from orbitfit.operators.kmeans import KMeansModel
from orbitfit.operators.layout import sorted_layout
from orbitfit.operators.prefix import running_total
from orbitfit.operators.scan import SUMMARY_SCHEMA, make_map_kernel
from orbitfit.operators.seeding import min_sq_distance
from orbitfit.sources.tables import LINEITEM_KEYS, lineitem_points, part_regression

START = [(5.0, 1.0), (15.0, 8.0), (25.0, 3.0)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _no_data_sized_cross(plan: str) -> None:
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_lloyd_step_prunes_and_combines_map_side(spark):
    pts = lineitem_points(spark, SF_SMALL)
    cl, _ = nearest([F.col("x"), F.col("y")], START)
    q = pts.select(cl.alias("cluster"), "x", "y").groupBy("cluster").agg(
        F.count(F.lit(1)), F.sum("x"), F.sum("y"))
    p = _plan(q)
    assert "ReadSchema: struct<l_quantity:double,l_discount:double>" in p
    assert "partial_count" in p and "partial_sum" in p
    assert p.index("partial_sum") > p.index("Exchange")  # partial below the exchange
    _no_data_sized_cross(p)


def test_seeding_round_is_one_global_aggregate(spark):
    pts = lineitem_points(spark, SF_SMALL)
    w = min_sq_distance([F.col("x"), F.col("y")], START)
    u = hash_uniform(LINEITEM_KEYS, 42, 1)
    q = pts.select((-F.log(u) / w).alias("key"), w.alias("w"), "x", "y").where("w > 0") \
        .agg(F.min(F.struct("key", "x", "y")))
    p = _plan(q)
    assert "partial_min" in p and "SinglePartition" in p
    _no_data_sized_cross(p)


def test_cluster_stats_single_aggregate_no_join(spark):
    pts = lineitem_points(spark, SF_SMALL)
    m = KMeansModel(["x", "y"], START, START, 0, False)
    p = _plan(m.cluster_stats(pts, around="mean"))
    assert "Join" not in p
    assert p.count("Exchange") == 1
    assert "partial_var_pop" in p or "partial_" in p


def test_sharded_pass_has_one_shuffle_and_no_sampling(spark):
    r = part_regression(spark, SF_SMALL)
    lay = sorted_layout(r, "shard", ["seq"], "y", ["x", "bias"], 200, 4)
    q = lay.mapInArrow(make_map_kernel("heavy_ball", 2, [1e-7, 2e-7], 0.6), SUMMARY_SCHEMA)
    p = _plan(q)
    assert "REPARTITION_BY_NUM" in p and "MapInArrow" in p
    assert "rangepartitioning" not in p and "hashpartitioning" not in p
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in p


def test_running_total_one_range_shuffle_broadcasts_only_offsets(spark):
    pts = lineitem_points(spark, SF_SMALL)
    # x, y are carried along but not part of the order: nothing may prune
    # them below the range exchange in one branch only.
    data = pts.select(*LINEITEM_KEYS, "x", "y", F.col("x").alias("w"),
                      hash_uniform(LINEITEM_KEYS, 1).alias("u"))
    q = running_total(data, "w", "u", LINEITEM_KEYS, buckets=4)
    q.collect()
    p = _plan(q)
    assert "BroadcastHashJoin" in p and "MapInArrow" in p
    # one range shuffle of the rows, read twice (totals and running sums)
    final = p.split("== Initial Plan ==")[0]
    assert final.count("+- Exchange rangepartitioning(u") == 1 and "ReusedExchange" in final
    _no_data_sized_cross(p)


def test_running_total_over_even_slices_reads_the_rows_once(spark):
    pts = lineitem_points(spark, SF_SMALL)
    data = pts.select(*LINEITEM_KEYS, F.col("x").alias("w"), hash_uniform(LINEITEM_KEYS, 1).alias("u"))
    q = running_total(data, "w", "u", LINEITEM_KEYS, buckets=4, even=True)
    q.collect()
    final = _plan(q).split("== Initial Plan ==")[0]
    # no range bounds, so no sampling pass; one scan, one shuffle of the rows, read twice
    assert "rangepartitioning" not in final and final.count("FileScan") == 1
    # the second is the reuse (a third exchange deals the B partition totals into one task)
    assert final.count("direct_shuffle_partition_id") == 2 and "ReusedExchange" in final


def test_centre_pairs_need_no_join(spark):
    centres = START + [(3.0, 3.0), (40.0, 9.0)]
    m = KMeansModel(["x", "y"], centres, centres, 0, False)
    q = m.inter_cluster_distances(spark)
    p = _plan(q)
    assert "Join" not in p and "Exchange" not in p and "Generate" in p
    _no_data_sized_cross(p)
    rows = q.collect()
    assert sorted((r["cluster_1"], r["cluster_2"]) for r in rows) == \
        [(i, j) for i in range(5) for j in range(i + 1, 5)]
