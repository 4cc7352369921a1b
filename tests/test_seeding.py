import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from orbitfit.operators.prefix import running_total, scalar_uniform, threshold_draw
from orbitfit.operators.sampling import sample_by_hash
from orbitfit.operators.seeding import kmeanspp_init, weighted_draw
from orbitfit.functions.random import hash_uniform
from orbitfit.sources.tables import LINEITEM_KEYS, lineitem_points


def test_weighted_draw_frequencies(spark):
    # weights 0:1:2:5 -> the zero-weight row is never drawn; the others ~ 1:2:5
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, 2.0), (3, 5.0)], "id long, x double")
    counts = {0.0: 0, 1.0: 0, 2.0: 0, 5.0: 0}
    n = 80
    for salt in range(n):
        counts[weighted_draw(df, F.col("x"), ["id"], ["x"], seed=7, salt=salt)[0]] += 1
    assert counts[0.0] == 0
    for w in (1.0, 2.0, 5.0):
        assert abs(counts[w] / n - w / 8) < 0.12


def test_kmeanspp_distinct_and_repeatable(spark):
    df = lineitem_points(spark, SF_SMALL)
    a = kmeanspp_init(df, LINEITEM_KEYS, ["x", "y"], 5, seed=3)
    b = kmeanspp_init(df.repartition(5), LINEITEM_KEYS, ["x", "y"], 5, seed=3)
    assert a == b
    assert len(set(a)) == 5


def test_kmeanspp_all_equal_points_errors(spark):
    df = spark.createDataFrame([(i, 1.0, 1.0) for i in range(10)], "id long, x double, y double")
    with pytest.raises(ValueError):
        kmeanspp_init(df, ["id"], ["x", "y"], 2)


def test_sample_by_hash_is_smallest_uniforms(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    got = [r["k"] for r in sample_by_hash(df, ["k"], 7, seed=1).collect()]
    allu = sorted((r["u"], r["k"]) for r in df.select("k", hash_uniform(["k"], 1).alias("u")).collect())
    assert got == [k for _, k in allu[:7]]


@pytest.mark.parametrize("even", [False, True])
def test_running_total_matches_brute_force(spark, even):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("w"))
    data = df.withColumn("u", hash_uniform(["k"], 5))
    got = {r["k"]: (r["cum_before"], r["cum_through"]) for r in
           running_total(data, "w", "u", ["k"], buckets=8, even=even).collect()}
    rows = sorted((r["u"], r["k"], r["w"]) for r in data.collect())
    acc = 0.0
    for _, k, w in rows:
        assert got[k] == (acc, acc + w)
        acc += w
    r = scalar_uniform(5, "t")
    d = threshold_draw(running_total(data, "w", "u", ["k"], buckets=8, even=even), "w", "u", ["k"], r).collect()[0]
    acc = 0.0
    for _, k, w in rows:
        acc += w
        if acc >= r * sum(x[2] for x in rows):
            assert d["k"] == k
            break


@pytest.mark.parametrize("tie", [None, "rid"])
def test_running_total_splits_a_group_of_copies(spark, tie):
    """One key copied so often that it holds a third of all rows: the copies
    are cut over several partitions, and the totals equal a row-by-row pass
    (copies are interchangeable, so compare per key the multiset of sums)."""
    from collections import Counter
    from orbitfit.operators.prefix import ordered_layout
    base = spark.range(600).select(F.col("id").alias("k"), (F.col("id") % 5 + 1).cast("double").alias("w"))
    hot = spark.range(300).select(F.lit(7).cast("long").alias("k"), F.lit(3.0).alias("w"))
    data = base.where("k != 7").unionByName(hot).withColumn("u", hash_uniform(["k"], 2))
    if tie:
        data = data.withColumn(tie, F.monotonically_increasing_id())
    sizes = Counter(r["p"] for r in ordered_layout(data, "u", ["k"], 6, tie)
                    .select(F.spark_partition_id().alias("p")).collect())
    assert len(sizes) == 6 and max(sizes.values()) < 300 * 0.75
    got = Counter((r["k"], r["cum_before"], r["cum_through"])
                  for r in running_total(data, "w", "u", ["k"], buckets=6, tie=tie).collect())
    acc, exp = 0.0, Counter()
    for _, k, w in sorted((r["u"], r["k"], r["w"]) for r in data.collect()):
        exp[(k, acc, acc + w)] += 1
        acc += w
    assert got == exp


def test_crowded_slices_are_seen():
    from orbitfit.operators.prefix import SLICES, evenly_sliced
    assert evenly_sliced([1000] * SLICES, 40_000) and evenly_sliced([], 1)
    assert evenly_sliced([1000] * (SLICES - 1) + [1200], 40_000)                  # noise
    assert not evenly_sliced([1000] * (SLICES - 1) + [2000], 40_000)              # copies of many partitions
    assert evenly_sliced([1000] * (SLICES - 1) + [2000], 8)                       # far below one partition
    assert not evenly_sliced([1000] * (SLICES - 1) + [SLICES * 500], 8)           # a third of all rows


def test_incremental_seeding_draws_the_same_centres(spark, monkeypatch):
    """The persisted running-minimum path (with a rebuild every 3 rounds)
    draws exactly the centres of the recompute-all path."""
    from orbitfit.operators import seeding
    from orbitfit.sources.tables import LINEITEM_KEYS, lineitem_points
    monkeypatch.setattr(seeding, "REBUILD_EVERY", 3)
    pts = lineitem_points(spark, SF_SMALL)
    a = kmeanspp_init(pts, LINEITEM_KEYS, ["x", "y"], 9, seed=7, incremental=False)
    b = kmeanspp_init(pts, LINEITEM_KEYS, ["x", "y"], 9, seed=7, incremental=True)
    assert a == b and len(set(a)) == 9


def test_kmeanspp_reads_a_kept_copy(spark, monkeypatch):
    from orbitfit.operators import seeding
    plans = []
    draw = seeding.weighted_draw

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().withCachedData().toString())
        return draw(df, *args)

    monkeypatch.setattr(seeding, "weighted_draw", seen)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    seeding.kmeanspp_init(lineitem_points(spark, SF_SMALL), LINEITEM_KEYS, ["x", "y"], 4)
    assert len(plans) == 3 and all("InMemoryRelation" in p for p in plans)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_running_total_does_not_depend_on_the_partitions(spark):
    """Unrounded weights of very different sizes: 1, 7 and 64 partitions give the same bits, those of exact sums."""
    import math
    data = spark.range(3000).select(F.col("id").alias("k"), (F.exp((F.col("id") * 37) % 50 - 25) / 3).alias("w"))
    data = data.withColumn("u", hash_uniform(["k"], 9))
    got = [{r["k"]: (r["cum_before"], r["cum_through"]) for r in running_total(data, "w", "u", ["k"], buckets=b, even=e).collect()}
           for b, e in ((1, False), (7, False), (64, True))]
    assert got[0] == got[1] == got[2]
    rows = sorted((r["u"], r["k"], r["w"]) for r in data.collect())
    w = [r[2] for r in rows]
    for i in range(0, 3000, 61):
        assert got[0][rows[i][1]] == (math.fsum(w[:i]), math.fsum(w[:i + 1]))


def test_running_total_of_infinite_and_null_weights(spark):
    df = spark.createDataFrame([(1, 0.1, 1.0), (2, 0.2, None), (3, 0.3, float("inf")), (4, 0.4, 2.0)],
                               "k long, u double, w double")
    for b in (1, 3):
        got = {r["k"]: (r["cum_before"], r["cum_through"]) for r in running_total(df, "w", "u", ["k"], buckets=b).collect()}
        inf = float("inf")
        assert got == {1: (0.0, 1.0), 2: (1.0, 1.0), 3: (1.0, inf), 4: (inf, inf)}
