
from sf_dirs import SF_SMALL
from orbitfit.operators.kmeans import kmeans_fit
from orbitfit.sources.tables import LINEITEM_KEYS, lineitem_points
from orbitfit.streaming import assign_stream


def test_stream_assignment_equals_batch(spark, tmp_path):
    batch = lineitem_points(spark, SF_SMALL)
    model = kmeans_fit(batch, ["x", "y"], 5, keys=LINEITEM_KEYS, init="random", max_iter=30)
    src = str(tmp_path / "src")
    batch.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    q = (assign_stream(stream, model, keys=LINEITEM_KEYS).writeStream.format("memory")
         .queryName("assigned_stream").outputMode("append").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table("assigned_stream")
    want = model.assign(batch, keys=LINEITEM_KEYS)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
