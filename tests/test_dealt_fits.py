"""Local SGD whose shards are too large for a task: what is hashed, sorted and read at once."""

import pyarrow as pa
from pyspark.sql import functions as F

from orbitfit.functions.random import hash_uniform, key_text, text_uniform
from orbitfit.operators import momentum, scan


def test_small_batches_are_joined_for_the_kernel():
    batches = [pa.RecordBatch.from_pydict({"a": list(range(i, i + 10))}) for i in range(0, 100, 10)]
    got = list(scan.pieces(iter(batches), 1))
    assert len(got) == 1 and got[0].column(0).to_pylist() == list(range(100))
    assert [b.num_rows for b in scan.pieces(iter(batches), scan.BLOCK_DOUBLES // 25)] == [25, 5] * 3 + [10]


def test_key_text_gives_the_same_uniform(spark):
    df = spark.createDataFrame([(1, 2.5, "a:b"), (None, None, None), (-7, float("nan"), "\\")], "k long, v double, s string")
    text = key_text(["k", "v", "s"], 42, numbers=["k", "v"])
    got = df.select(hash_uniform(["k", "v", "s"], 42, 3).alias("a"), text_uniform(F.concat_ws(":", text, F.lit("3"))).alias("b"))
    assert all(r["a"] == r["b"] for r in got.collect())


def test_dealt_rows_sort_by_shard_and_place_at_once(spark, monkeypatch):
    """The sort's first key differs for most rows, and the order is that of shard and permutation."""
    seen = []
    deal = momentum.ordered_cuts

    def spied(*args):
        seen.append(deal(*args))
        return seen[-1]

    monkeypatch.setattr(momentum, "ordered_cuts", spied)
    monkeypatch.setattr(momentum, "PERMUTED_ROWS", 10)
    rows = [(s, i, float(i % 5), 1.0) for s in (-3, 0, 2**60) for i in range(200)]
    df = spark.createDataFrame(rows, "shard long, seq long, y double, x double")
    momentum.local_sgd(df, "y", ["x"], "shard", ["seq"], 1, 1e-4)
    lead = seen[0].lead
    assert lead is not None
    keyed = df.withColumn("_perm", hash_uniform(["seq"], 42, 1))
    a = keyed.orderBy("shard", "_perm").select(F.expr(lead)).collect()
    assert [r[0] for r in a] == sorted(r[0] for r in a)
    assert len({r[0] for r in a}) == 401
