"""Owned intermediates: nothing is left in the shared folder or the cache, after errors as well."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orbitfit import session
from orbitfit.operators.kmeans import kmeans_fit
from orbitfit.operators.momentum import heavy_ball, local_sgd
from orbitfit.operators.seeding import kmeanspp_init
from orbitfit.session import Scope, materialize, release, shared_dir, work_path
from orbitfit.sources.tables import LINEITEM_KEYS, line_dataset, lineitem_points
from sf_dirs import SF_SMALL


def _files(spark) -> set:
    top = shared_dir(spark).removeprefix("file:")
    return {os.path.join(d, f) for d, _, names in os.walk(top) for f in names}


def _kept(spark) -> int:
    return spark.sparkContext._jsc.getPersistentRDDs().size()


@pytest.mark.parametrize("name", ["csv_points", "csv_multiline", "kmeans_many_centres", "kmeanspp_fit", "local_sgd_history"])
def test_queries_leave_nothing(spark, name):
    files, kept = _files(spark), _kept(spark)
    with Scope(spark):
        assert entry.queries()[name](spark, SF_SMALL).count() > 0
    assert _files(spark) == files and _kept(spark) == kept


def test_a_failing_query_leaves_nothing(spark):
    files, kept = _files(spark), _kept(spark)
    with pytest.raises(RuntimeError, match="stop"):
        with Scope(spark):
            path = work_path(spark, "half")
            spark.range(5).write.parquet(path)
            materialize(spark.range(7)).count()
            materialize(spark.range(9), "checkpoint").count()
            assert _files(spark) > files and _kept(spark) > kept
            raise RuntimeError("stop")
    assert _files(spark) == files and _kept(spark) == kept


def test_checkpointed_fits_free_their_files(spark):
    files = _files(spark)
    pts = lineitem_points(spark, SF_SMALL)
    for init in ("random", "k-means++"):
        kmeans_fit(pts, ["x", "y"], 4, keys=LINEITEM_KEYS, init=init, max_iter=3, cache="checkpoint", spread_input=True)
        assert _files(spark) == files
    with pytest.raises(ValueError):
        kmeans_fit(pts.limit(2), ["x", "y"], 4, init=[(float(i), 0.0) for i in range(4)], cache="checkpoint")
    kmeanspp_init(pts, LINEITEM_KEYS, ["x", "y"], 3, cache="checkpoint")
    local_sgd(line_dataset(spark), "y", ["x", "bias"], "shard", ["seq"], 2, cache="checkpoint")
    assert _files(spark) == files


def test_inner_scopes_and_failing_frees(spark):
    freed = []
    with Scope(spark) as outer:
        outer.own("a", lambda: freed.append("a"))
        with Scope(spark) as inner:
            assert Scope.current() is inner
            inner.own("b", lambda: freed.append("b"))
        assert freed == ["b"] and Scope.current() is outer

        def fail():
            raise OSError("disk")
        outer.own("c", fail)
        outer.own("d", lambda: freed.append("d"))
        with pytest.raises(OSError):
            outer.close()
    assert freed == ["b", "d", "a"] and Scope.current() is None


def test_loose_files_are_released(spark):
    release(spark)
    files = _files(spark)
    spark.range(3).write.parquet(work_path(spark, "loose"))
    materialize(spark.range(3).select(F.col("id") + 1), "checkpoint")
    assert _files(spark) > files and len(session._LOOSE) == 2
    assert release(spark) == 2 and _files(spark) == files


def test_results_can_be_read_until_the_scope_ends(spark):
    with Scope(spark):
        df = entry.queries()["csv_points"](spark, SF_SMALL)
        assert df.count() == df.filter("lat IS NOT NULL OR lat IS NULL").count()
    line = heavy_ball(line_dataset(spark), "y", ["x", "bias"], "shard", ["seq"], 2, cache="checkpoint")
    assert len(line.history) == 2
