"""Execute the core jobs once and write their final physical plans to PLANS.md.

Usage: python tools/show_plans.py [sf_dir] [out_file]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from orbitfit.functions.random import hash_uniform  # noqa: E402
from orbitfit.functions.vector import nearest  # noqa: E402
from orbitfit.operators.blocks import PARTIAL_SCHEMA, make_partial_kernel  # noqa: E402
from orbitfit.operators.kmeans import KMeansModel  # noqa: E402
from orbitfit.operators.layout import sorted_layout  # noqa: E402
from orbitfit.operators.linear import normal_stats_table  # noqa: E402
from orbitfit.operators.points import project_points  # noqa: E402
from orbitfit.operators.prefix import running_total  # noqa: E402
from orbitfit.operators.sampling import sample_by_hash  # noqa: E402
from orbitfit.operators.scan import SUMMARY_SCHEMA, make_map_kernel, reduce_levels  # noqa: E402
from orbitfit.operators.seeding import min_sq_distance  # noqa: E402
from orbitfit.session import get_session  # noqa: E402
from orbitfit.sources.tables import LINEITEM_KEYS, lineitem_points, part_regression, table  # noqa: E402

START = [(5.0, 1.0), (15.0, 8.0), (25.0, 3.0), (35.0, 9.0), (45.0, 5.0)]


def plan(df, width: int = 220) -> str:
    df.collect() if df.isStreaming is False else None
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    if "== Final Plan ==" in text:  # keep the executed (adaptive) plan only
        text = text.split("== Final Plan ==", 1)[1].split("+- == Initial Plan ==", 1)[0]
    lines = [ln.rstrip()[:width] + (" ..." if len(ln.rstrip()) > width else "") for ln in text.splitlines()]
    return "\n".join(ln for ln in lines if ln.strip())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = get_session("local[8]", 8)
    pts = lineitem_points(spark, sf)
    xs = [F.col("x"), F.col("y")]
    feats = pts.select("x", "y").repartition(8).cache()
    feats.count()
    cl, _ = nearest(xs, START)
    sections = []
    sections.append(("Lloyd iteration (cached features, literal centres)",
                     feats.select(cl.alias("cluster"), *xs).groupBy("cluster")
                     .agg(F.count(F.lit(1)).alias("n"), F.sum("x"), F.sum("y"))))
    emb, names = project_points(table(spark, sf, "embeddings"), "embedding", ["vec_id"])
    cent = [tuple(float(j % 7) / 10 for j in range(64)) for _ in range(10)]
    sections.append(("Wide Lloyd iteration (NumPy blocks, 64-d, K=10)",
                     emb.select(*names).mapInArrow(make_partial_kernel(names, cent), PARTIAL_SCHEMA)
                     .groupBy("cluster", "dim").agg(F.sum("s"))))
    w = min_sq_distance(xs, START[:2])
    u = hash_uniform(LINEITEM_KEYS, 42, 2)
    sections.append(("Distance-squared seeding round (exponential race)",
                     pts.select((-F.log(u) / w).alias("key"), w.alias("w"), "x", "y").where(F.col("w") > 0)
                     .agg(F.min(F.struct("key", "x", "y")))))
    sections.append(("Seeded K-point sample", sample_by_hash(pts, LINEITEM_KEYS, 5, 42, tie_cols=["x", "y"])))
    model = KMeansModel(["x", "y"], START, START, 0, False)
    sections.append(("Cluster statistics around the mean (one aggregate)",
                     model.cluster_stats(pts, around="mean")))
    sections.append(("Centre-to-centre distances (partner ids exploded over K rows, no join)",
                     model.inter_cluster_distances(spark)))
    r = part_regression(spark, sf)
    lay = sorted_layout(r, "shard", ["seq"], "y", ["x", "bias"], r.count(), 13)
    maps = lay.mapInArrow(make_map_kernel("heavy_ball", 2, [1e-7, 9e-8], 0.6), SUMMARY_SCHEMA)
    sections.append(("Sharded heavy ball, all epochs in one pass (counted layout + affine scan kernel)", maps))
    sections.append(("Summary merge levels (fan-in 3 over 13 partitions; 1024 by default)",
                     reduce_levels(maps, 5, 13, fanin=3)))
    sections.append(("Sufficient statistics (one aggregate)", normal_stats_table(r, "y", ["x", "bias"])))
    data = pts.select(*LINEITEM_KEYS, "x", "y", F.col("x").alias("w"), hash_uniform(LINEITEM_KEYS, 42, 1).alias("u"))
    sections.append(("Running total (one range shuffle, reused; Arrow prefix sums)", running_total(data, "w", "u", LINEITEM_KEYS)))
    with open(out, "w") as fh:
        fh.write("# Physical plans of the core jobs\n\n")
        fh.write(f"Generated by `tools/show_plans.py` on `{sf}` (local[8]); each job was executed "
                 "first, so adaptive plans show their final form. Long expressions are cut.\n\n")
        for title, df in sections:
            fh.write(f"## {title}\n\n```\n{plan(df)}\n```\n\n")
    print("wrote", out)


if __name__ == "__main__":
    main()
