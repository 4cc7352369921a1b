"""Ordered layouts: order, evenness, no sampling."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orbitfit.operators import scan
from orbitfit.operators.layout import ordered_cuts, sorted_layout
from orbitfit.operators.momentum import heavy_ball
from orbitfit.sources.tables import line_dataset, table

SF = "/root/testdata/sf0.1"


def _dealt(df, keys, rows, partitions, whole=None):
    """(partition, keys...) of all rows in scan order."""
    lay = ordered_cuts(df, keys, rows, partitions, whole).deal(df)
    return [tuple(r) for r in lay.select(F.spark_partition_id().alias("p"), *keys).collect()]


def _check_order(got, want):
    got = sorted(got, key=lambda r: r[0])    # stable: the order inside a partition stays
    assert [r[1:] for r in got] == want


def _key(v):
    if v is None:
        return (0, 0)
    return (2, 0) if isinstance(v, float) and v != v else (1, v)


@pytest.mark.parametrize("partitions", [1, 2, 7, 40])
def test_partitions_follow_the_order(spark, partitions):
    """Hot values, far outliers, NULL, infinities and copies."""
    rng = random.Random(partitions)
    rows = [(rng.choice([3, 3, 3, -8, 10 ** 15, 2 ** 60, 2 ** 60 + 1, 4]), rng.choice([None, 1.5, -1e300, 1e308, float("inf"), rng.random(), 0.25]))
            for _ in range(600)]
    df = spark.createDataFrame(rows, "a long, b double").withColumn("_tie", F.monotonically_increasing_id())
    got = _dealt(df, ["a", "b", "_tie"], 600, partitions)
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(_key, r)))
    _check_order(got, want)
    sizes = Counter(r[0] for r in got)
    assert len(sizes) <= partitions * 1.5 + 1
    assert max(sizes.values()) <= max(600 / partitions * 1.3, 1.2 * sum(r[1] > 2 ** 59 for r in got)) + 1


def test_dates_and_timestamps(spark):
    days = [(datetime.date(2020, 1, 1) + datetime.timedelta(days=i * i % 997), datetime.datetime(2020, 1, 1, 0, 0, i % 60))
            for i in range(300)]
    df = spark.createDataFrame(days, "d date, t timestamp_ntz")
    got = _dealt(df, ["d", "t"], 300, 5)
    _check_order(got, sorted(days))
    assert max(Counter(r[0] for r in got).values()) <= 80


def test_other_types_are_range_partitioned(spark):
    df = line_dataset(spark, n=400, shards=2).withColumn("name", F.format_string("%05d", "seq"))
    args = ("y", ["x", "bias"], "shard")
    want = heavy_ball(df, *args, ["seq"], 2)
    got = heavy_ball(df, *args, ["name"], 2)
    assert got.w == want.w


def test_a_key_can_be_kept_whole(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("shard"), F.col("id").alias("seq"))
    got = _dealt(df, ["shard", "seq"], 1000, 4, "shard")
    homes = {}
    for p, s, _ in got:
        homes.setdefault(s, set()).add(p)
    assert all(len(h) == 1 for h in homes.values()) and len({p for p, *_ in got}) >= 4


def test_hot_lineitem_shard_splits_evenly_without_a_sample(spark):
    """A shard with a third of lineitem: partitions even, no range partitioning in the plan."""
    li = table(spark, SF, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, -1).otherwise(F.col("l_suppkey") % 50).cast("long").alias("shard"),
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("x"))
    n = li.count()
    lay = sorted_layout(li, "shard", ["l_orderkey", "l_linenumber"], "y", ["x"], n, 24)
    sizes = [r["count"] for r in lay.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and 24 <= len(sizes) <= 32
    assert max(sizes) <= 1.3 * n / 24
    hot = lay.filter("shard = -1").groupBy(F.spark_partition_id()).count().count()
    assert hot >= 8
    plan = lay._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "REPARTITION_BY_NUM" in plan


def test_equal_order_values_keep_input_order_and_split(spark):
    """A hot shard whose order column is constant: the row id keeps the input order and is cut."""
    rng = random.Random(5)
    rows = [(0, 0, rng.gauss(0, 1), rng.gauss(0, 1), i) for i in range(600)]
    df = spark.createDataFrame(rows, "shard long, seq long, y double, x double, i long").coalesce(3)
    lay = sorted_layout(df, "shard", ["seq"], "y", ["x"], 600, 6, keep=["i"])
    got = lay.select(F.spark_partition_id().alias("p"), "k0").collect()
    assert [r["k0"] for r in sorted(got, key=lambda r: r["p"])] == [r["i"] for r in df.collect()]
    assert max(Counter(r["p"] for r in got).values()) <= 150


def test_layout_is_sized_from_the_row_count(spark, monkeypatch):
    """The layout gets an explicit, row-sized partition count, spread over
    the cores only while tasks keep enough rows; not spark.sql.shuffle.partitions."""
    from orbitfit import session
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(scan, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(session, "MIN_ROWS_PER_TASK", 50)
    assert scan.layout_partitions(spark, 1) == 1          # tiny: not one per core
    assert scan.layout_partitions(spark, 120) == min(cores, 3)
    assert scan.layout_partitions(spark, 1001) == 11      # about 100 rows each
    line = line_dataset(spark, n=1000, shards=10)
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        lay = sorted_layout(line, "shard", ["seq"], "y", ["x", "bias"], 1000, scan.layout_partitions(spark, 1000))
        assert 10 <= lay.rdd.getNumPartitions() <= 13
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
