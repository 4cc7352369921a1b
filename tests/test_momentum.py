import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orbitfit.operators.momentum import heavy_ball, local_sgd, nesterov
from orbitfit.operators import scan
from orbitfit.operators.scan import run_maps, run_products
from orbitfit.sources.tables import line_dataset

# Golden trajectories (FIXTURES F7): generated line, step 1e-7/(1 + 0.01 epoch),
# momentum 0.6, ten shards of 100 rows, unweighted average.
HB = {1: (0.949587006503, 0.00169164354405, 3594.10035265, -0.00110799628408, -5.51629086744e-06),
      2: (1.00004093552, 0.00179393761495, 3.83146655643, -5.45832451174e-05, -2.9053408958e-07),
      10: (1.00277149174, 0.00185855057515, 3.15845692543, 2.19689287084e-06, -9.22455267341e-09),
      50: (1.00267532509, 0.00211852860937, 2.84471559105, 1.49571035237e-06, -1.18115540387e-08)}
NAG = {1: (0.75912029703, 0.000543564356436, 78331.2771671, -0.75912029703, -0.000543564356436),
       2: (0.599120491314, 0.000429253463017, 215879.625904, 0.159999805716, 0.000114310893419),
       10: (0.985476068142, 0.000707412026738, 343.331741314, 0.0276443378924, 1.9590964901e-05),
       50: (1.00143100886, 0.000725488082571, 1.00552062014, 9.43949489123e-11, -1.43629599638e-07)}


def _check(hist, golden):
    for e, (w0, w1, loss, v0, v1) in golden.items():
        h = hist[e - 1]
        assert h[0] == e
        assert h[2] == pytest.approx(w0, rel=1e-8)
        assert h[3] == pytest.approx(w1, rel=1e-8)
        assert h[6] == pytest.approx(loss, rel=1e-8)
        assert h[4] == pytest.approx(v0, rel=1e-8, abs=1e-12)
        assert h[5] == pytest.approx(v1, rel=1e-8, abs=1e-12)


def test_heavy_ball_golden(spark):
    r = heavy_ball(line_dataset(spark), "y", ["x", "bias"], "shard", ["seq"], 50, 1e-7, 0.01, 0.6)
    _check(r.history, HB)


def test_nesterov_golden(spark):
    r = nesterov(line_dataset(spark), "y", ["x", "bias"], "shard", ["seq"], 50, 1e-7, 0.01, 0.6)
    _check(r.history, NAG)


def _sequential(method, rows, w, v, s, g):
    w, v = np.array(w, float), np.array(v, float)
    look = w - g * v
    for y, p in rows:
        p = np.array(p, float)
        if method == "sgd":
            w = w - (p * (2 * (w @ p - y))) * s
        elif method == "heavy_ball":
            v = v * g + (p * (2 * (w @ p - y))) * s
            w = w - v
        else:
            v = v * g + (p * (2 * (look @ p - y))) * s
    return w, v


def test_one_hot_shard_split_over_tasks(spark, monkeypatch):
    """A single shard holding every row is split over range partitions; the
    result equals the row-by-row recurrence."""
    n = 3000
    monkeypatch.setattr(scan, "ROWS_PER_PARTITION", 500)  # six partitions
    df = spark.range(n).select(F.col("id").alias("seq"), F.lit(0).cast("long").alias("shard"),
                               ((F.col("id") % 17) / 10.0 + 1.0).alias("y"),
                               ((F.col("id") % 13) / 13.0).alias("x"), F.lit(1.0).alias("bias"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = heavy_ball(df, "y", ["x", "bias"], "shard", ["seq"], 1, 0.01, 0.0, 0.5)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    rows = [((i % 17) / 10.0 + 1.0, [(i % 13) / 13.0, 1.0]) for i in range(n)]
    w, v = _sequential("heavy_ball", rows, [0.0, 0.0], [0.0, 0.0], 0.01 / 1.0, 0.5)
    assert r.w == pytest.approx(list(w), rel=1e-9)
    assert r.v == pytest.approx(list(v), rel=1e-9, abs=1e-12)


def test_local_sgd_one_shard_is_row_by_row(spark):
    line = line_dataset(spark, n=200, shards=1)
    r = local_sgd(line, "y", ["x", "bias"], "shard", ["seq"], 2, 1e-7, 0.01, permute="none")
    rows = [(2 * i + 3.0, [2 * i + 1.0, 1.0]) for i in range(200)]
    w = [0.0, 0.0]
    for e in (1, 2):
        w, _ = _sequential("sgd", rows, w, [0, 0], 1e-7 / (1 + 0.01 * e), 0.0)
    assert r.w == pytest.approx(list(w), rel=1e-10)


def test_shards_with_gaps_are_ignored(spark):
    a = line_dataset(spark)
    b = a.withColumn("shard", F.col("shard") * 3 + 5)  # ids with gaps
    ra = nesterov(a, "y", ["x", "bias"], "shard", ["seq"], 2, 1e-7, 0.01, 0.6)
    rb = nesterov(b, "y", ["x", "bias"], "shard", ["seq"], 2, 1e-7, 0.01, 0.6)
    assert ra.w == pytest.approx(rb.w, rel=1e-12)


@pytest.mark.parametrize("fanin", [None, 3])
@pytest.mark.parametrize("method", ["sgd", "heavy_ball", "nesterov"])
def test_mixed_shards_stitched_across_partitions(spark, method, fanin, monkeypatch):
    """Shards of 1..40 rows plus one hot shard with a third of all rows, over
    many range partitions: equals the per-shard sequential recurrence. With
    fan-in 3 the 13 partition summaries are merged on executors in two levels."""
    if fanin:
        monkeypatch.setattr(scan, "STITCH_FANIN", fanin)
    rng = np.random.default_rng(1)
    sizes = [int(s) for s in rng.integers(1, 40, size=30)]
    sizes.insert(11, sum(sizes) // 2)  # hot shard: a third of the rows
    rows, seq = [], 0
    for sh, n in enumerate(sizes):
        for _ in range(n):
            rows.append((seq, sh * 7, float(rng.normal()), float(rng.normal())))
            seq += 1
    df = spark.createDataFrame(rows, "seq long, shard long, y double, x double").withColumn("bias", F.lit(1.0))
    # about 13 range partitions (the layout is sized from the row count)
    monkeypatch.setattr(scan, "ROWS_PER_PARTITION", len(rows) // 13 + 1)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        if method == "sgd":
            r = local_sgd(df, "y", ["x", "bias"], "shard", ["seq"], 2, 0.01, 0.0, permute="none")
        elif method == "heavy_ball":
            r = heavy_ball(df, "y", ["x", "bias"], "shard", ["seq"], 2, 0.01, 0.0, 0.5)
        else:
            r = nesterov(df, "y", ["x", "bias"], "shard", ["seq"], 2, 0.01, 0.0, 0.5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    by_shard = {}
    for _, sh, y, x in rows:
        by_shard.setdefault(sh, []).append((y, [x, 1.0]))
    w, v = np.zeros(2), np.zeros(2)
    for _ in range(2):
        outs_w, outs_v = [], []
        for sh in sorted(by_shard):
            ws, vs = _sequential(method, by_shard[sh], w, v, 0.01, 0.5)
            if method == "nesterov":
                ws = w - vs
            outs_w.append(ws)
            outs_v.append(vs)
        w, v = np.mean(outs_w, axis=0), (np.mean(outs_v, axis=0) if method != "sgd" else v)
    assert r.w == pytest.approx(list(w), rel=1e-9, abs=1e-12)
    if method != "sgd":
        assert r.v == pytest.approx(list(v), rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("fanin", [None, 2])
def test_sequential_sgd_chains_shards_in_order(spark, fanin, monkeypatch):
    """combine='sequential' equals one driver loop over shards in order and
    rows in their seeded per-epoch permutation (the reference's plain SGD)."""
    from orbitfit.operators.prefix import scalar_uniform
    if fanin:
        monkeypatch.setattr(scan, "STITCH_FANIN", fanin)
    line = line_dataset(spark, n=300, shards=3)
    r = local_sgd(line, "y", ["x", "bias"], "shard", ["seq"], 3, 1e-7, 0.01, seed=42,
                  permute="epoch", combine="sequential")
    w = np.zeros(2)
    for e in (1, 2, 3):
        for sh in range(3):
            ids = sorted(range(sh * 100, sh * 100 + 100), key=lambda i: (scalar_uniform(i, 42, e), i))
            rows = [(2 * i + 3.0, [2 * i + 1.0, 1.0]) for i in ids]
            w, _ = _sequential("sgd", rows, w, [0, 0], 1e-7 / (1 + 0.01 * e), 0.0)
    assert r.w == pytest.approx(list(w), rel=1e-10)


def test_history_views(spark):
    """Weight, loss and velocity histories as temp views read by SQL,
    one row per epoch with an explicit epoch column."""
    r = heavy_ball(line_dataset(spark), "y", ["x", "bias"], "shard", ["seq"], 3, 1e-7, 0.01, 0.6)
    r.register_views(spark, prefix="hb_")
    w = spark.sql("SELECT * FROM hb_weightHistoryView ORDER BY epoch").collect()
    loss = spark.sql("SELECT * FROM hb_lossHistoryView ORDER BY epoch").collect()
    vel = spark.sql("SELECT * FROM hb_velocityHistoryView ORDER BY epoch").collect()
    assert [x["epoch"] for x in w] == [1, 2, 3] == [x["epoch"] for x in loss] == [x["epoch"] for x in vel]
    assert (w[-1]["w0"], w[-1]["w1"]) == (r.w[0], r.w[1])
    assert (vel[-1]["v0"], vel[-1]["v1"]) == (r.v[0], r.v[1])
    assert [x["loss"] for x in loss] == [h[-1] for h in r.history]


def test_run_products_of_several_runs():
    rng = np.random.default_rng(1)
    M = rng.normal(size=(23, 3, 3))
    starts = np.array([0, 1, 2, 9, 13, 22])
    got = run_products(M, starts)
    for k, (a, b) in enumerate(zip(starts, [*starts[1:], 23])):
        want = np.eye(3)
        for i in range(a, b):
            want = M[i] @ want
        assert np.allclose(got[k], want, rtol=1e-10)


def test_small_blocks_give_the_same_fit(spark, monkeypatch):
    from orbitfit.operators import scan
    df = line_dataset(spark)
    want = heavy_ball(df, "y", ["x", "bias"], "shard", ["seq"], epochs=2).w
    monkeypatch.setattr(scan, "BLOCK_DOUBLES", 200)   # 8 rows of 5 x 5 at a time
    assert heavy_ball(df, "y", ["x", "bias"], "shard", ["seq"], epochs=2).w == pytest.approx(want, rel=1e-10)


@pytest.mark.parametrize("method", ["sgd", "heavy_ball", "nesterov"])
def test_run_maps_equal_the_sequential_recurrence(method):
    """Maps of several runs and step sizes, chunks of every length, against a row-by-row loop."""
    rng = np.random.default_rng(0)
    starts = np.array([0, 1, 3, 67, 131, 330])
    n, gamma, steps = 400, 0.6, [0.01, 0.003]
    P, y = rng.normal(size=(n, 3)), rng.normal(size=n)
    w, v = rng.normal(size=3), 0.1 * rng.normal(size=3)
    maps = run_maps(method, y, P, starts, steps, gamma)
    for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
        for e, s in enumerate(steps):
            want_w, want_v = _sequential(method, list(zip(y[a:b], P[a:b])), w, v, s, gamma)
            if method == "nesterov":
                want_w = w - want_v
            got_w, got_v = scan.advance(method, s, gamma, maps[k, 0 if method == "nesterov" else e], w, v)
            assert got_w == pytest.approx(want_w, rel=1e-10, abs=1e-12)
            if method != "sgd":
                assert got_v == pytest.approx(want_v, rel=1e-10, abs=1e-12)


def test_rows_taken_in_another_order_per_epoch():
    rng = np.random.default_rng(5)
    P, y, w = rng.normal(size=(90, 2)), rng.normal(size=90), rng.normal(size=2)
    rows = np.stack([np.concatenate((rng.permutation(30), 30 + rng.permutation(60))) for _ in range(3)])
    maps = run_maps("sgd", y, P, np.array([0, 30]), [0.01, 0.02, 0.03], 0.0, rows)
    for e, s in enumerate([0.01, 0.02, 0.03]):
        for k, part in enumerate((rows[e, :30], rows[e, 30:])):
            want, _ = _sequential("sgd", [(y[i], P[i]) for i in part], w, [0, 0], s, 0.0)
            assert scan.advance("sgd", s, 0.0, maps[k, e], w, np.zeros(2))[0] == pytest.approx(want, rel=1e-10)


def _summaries(method, n_shards, cuts_at, chain=False, seed=3):
    """Kernel summaries of rows cut into partitions anywhere, and the maps of the whole shards."""
    rng = np.random.default_rng(seed)
    shards = np.repeat(np.arange(n_shards), rng.integers(1, 12, size=n_shards))
    y = rng.normal(size=len(shards))
    P = np.column_stack([rng.normal(size=len(shards)), np.ones(len(shards))])
    cuts = sorted(rng.choice(np.arange(1, len(shards)), size=cuts_at, replace=False))
    kernel = scan.make_map_kernel(method, 2, [0.01, 0.02], 0.5, chain)
    rows = []
    for part, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(shards)])):
        b = pa.RecordBatch.from_pydict({"shard": shards[lo:hi], "y": y[lo:hi], "p0": P[lo:hi, 0], "p1": P[lo:hi, 1]})
        rows += [dict(r, part=part) for out in kernel(iter([b])) for r in out.to_pylist()]
    starts = np.array([0]) if chain else scan.run_starts(shards)
    return rows, run_maps(method, y, P, starts, [0.01, 0.02], 0.5)


@pytest.mark.parametrize("chain", [False, True])
@pytest.mark.parametrize("method", ["sgd", "heavy_ball", "nesterov"])
def test_merged_summaries_give_the_sum_of_whole_shards(method, chain):
    """Any cuts into partitions, and merging any split of consecutive summaries first."""
    rows, maps = _summaries(method, 9, 10, chain)
    m = maps.shape[-1]
    for split in ([], [3, 7], [1, 2, 3, 4], [5]):
        groups, lo = [], 0
        for hi in [*split, len(rows)]:
            groups.append(scan.merged(rows[lo:hi], m).row(len(groups)))
            lo = hi
        total, count = scan.merged(groups, m).total()
        assert count == len(maps)
        assert np.allclose(total, maps.sum(axis=0), rtol=1e-11, atol=1e-12)


def test_three_merge_levels_on_executors(spark):
    """Forty partition summaries with fan-in 3 (40 -> 14 -> 5 -> 2 rows) give the same sum."""
    rows, maps = _summaries("heavy_ball", 30, 39, seed=11)
    assert len(rows) == 40
    merged = scan.reduce_levels(spark.createDataFrame(rows, scan.SUMMARY_SCHEMA), 5, 40, fanin=3).collect()
    assert len(merged) <= 3
    total, count = scan.merged(merged, 5).total()
    assert count == 30 and np.allclose(total, maps.sum(axis=0), rtol=1e-11, atol=1e-12)


def test_too_many_features_for_the_scan():
    with pytest.raises(ValueError, match="too many"):
        scan.state_dim("heavy_ball", 200)


def _jobs(spark, run):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "jobs of one fit")
    try:
        run()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setJobGroup("", "")


@pytest.mark.parametrize("fit", ["heavy_ball", "nesterov", "sgd_none", "sgd_epoch"])
def test_jobs_do_not_grow_with_the_epochs(spark, fit):
    line = line_dataset(spark)

    def run(epochs):
        args = ("y", ["x", "bias"], "shard", ["seq"], epochs)
        if fit.startswith("sgd"):
            return lambda: local_sgd(line, *args, permute=fit[4:])
        return lambda: {"heavy_ball": heavy_ball, "nesterov": nesterov}[fit](line, *args)

    run(1)()
    few, many = _jobs(spark, run(2)), _jobs(spark, run(100))
    # Three actions, a few rows for reference, the statistics and the pass (and the largest shard); each
    # shuffle counts as a job too.
    assert few == many and many <= 5 + 5 * (fit == "sgd_epoch")


def test_several_passes_equal_one(spark, monkeypatch):
    line = line_dataset(spark)
    args = (line, "y", ["x", "bias"], "shard", ["seq"], 7, 1e-7)
    want = [heavy_ball(*args).history, local_sgd(*args).history, local_sgd(*args, permute="none").history]
    monkeypatch.setattr(scan, "BLOCK_DOUBLES", 1024 * 60)
    got = [heavy_ball(*args).history, local_sgd(*args).history, local_sgd(*args, permute="none").history]
    assert scan.epochs_per_pass("heavy_ball", 2, 1) == 2
    for a, b in zip(want, got):
        assert np.allclose(a, b, rtol=1e-10)


@pytest.mark.parametrize("combine", ["average", "sequential"])
def test_shards_too_large_for_a_task_are_dealt_each_epoch(spark, monkeypatch, combine):
    """The two ways of drawing a fresh permutation give the same fit."""
    from orbitfit.operators import momentum
    line = line_dataset(spark, n=900, shards=4)
    args = (line, "y", ["x", "bias"], "shard", ["seq"], 3, 1e-8)
    monkeypatch.setattr(scan, "ROWS_PER_PARTITION", 100)
    want = local_sgd(*args, combine=combine)
    monkeypatch.setattr(momentum, "PERMUTED_ROWS", 10)
    got = local_sgd(*args, combine=combine)
    assert np.allclose(want.history, got.history, rtol=1e-10)


def test_null_shard_is_an_error(spark):
    df = line_dataset(spark, n=20, shards=2).withColumn("shard", F.when(F.col("seq") != 3, F.col("shard")))
    with pytest.raises(Exception, match="NULL shard"):
        heavy_ball(df, "y", ["x", "bias"], "shard", ["seq"], 1)
