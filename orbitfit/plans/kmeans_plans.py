"""Registered k-means queries (Spark) and their DuckDB oracles.

Points P: lineitem ``x = l_quantity``, ``y = l_discount * 100``, keyed by
``(l_orderkey, l_linenumber, l_partkey, l_suppkey)``; every query reads the
whole table. Computed doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.functions.random import hash_uniform, hash_uniform_sql
from orbitfit.functions.vector import array_add, array_dot, array_scale, array_subtract, sq_distance
from orbitfit.operators.kmeans import TIMING_METRICS, KMeansModel, kmeans_fit
from orbitfit.operators.points import project_points
from orbitfit.operators.prefix import (
    bucket_count, evenly_sliced, running_total, scalar_uniform, threshold_draw, u_slices,
)
from orbitfit.operators.sampling import sample_by_hash
from orbitfit.operators.seeding import kmeanspp_init, min_sq_distance
from orbitfit.session import spread
from orbitfit.plans.sqlgen import (
    centres_long, ccol, converged_ctes, d2_sql, dbl, kmeanspp_ctes, literal_centres_cte,
    list_centres_long, list_lloyd_ctes, lloyd_ctes, nearest_sql, random_init_ctes, significant, wide_to_long, with_,
)
from orbitfit.sources.tables import LINEITEM_KEYS, lineitem_points, table

# Fixed parameters of the registered k-means queries.
K = 5
START = [(5.0, 1.0), (15.0, 8.0), (25.0, 3.0), (35.0, 9.0), (45.0, 5.0)]
NAMES = ["x", "y"]
KEYS = LINEITEM_KEYS
SEED = 42
TOL = 0.1
MAX_ITER = 30
EMB_K = 10
EMB_DIM = 64
EMB_ITERS = 2
EMB_TOL, EMB_MAX_ITER = 1e-9, 40
MANY_K, MANY_ITERS = 100, 8
MANY_UNIT = 997.0   # a prime: mean prices then do not end in a 5 where they are rounded

R6 = 6
# Per-row distances to *fitted* centres (which two engines may compute one
# ulp apart) are compared at 4 decimals; everything else at 6.
FITTED_D2_DIGITS = 4


def _r(c, digits: int = R6):
    return F.round(c, digits)


def _fixed_model(centres) -> KMeansModel:
    return KMeansModel(names=list(NAMES), centres=[tuple(c) for c in centres],
                       init_centres=[tuple(c) for c in centres], iterations=0, converged=False)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_points(spark, sf_dir)


def _fit(spark: SparkSession, sf_dir: str, init: str = "random") -> KMeansModel:
    model = kmeans_fit(_points(spark, sf_dir), NAMES, K, keys=KEYS, init=init, tol=TOL,
                       max_iter=MAX_ITER, seed=SEED, spread_input=True)
    if not model.converged:
        raise RuntimeError(f"no convergence within {MAX_ITER} iterations")
    return model


def _centres_table(spark: SparkSession, model: KMeansModel, with_iterations: bool = False
                   ) -> DataFrame:
    c = model.centres_df(spark).select("cluster", *[_r(F.col(n)).alias(n) for n in NAMES])
    if with_iterations:
        c = c.withColumn("iterations", F.lit(model.iterations))
    return c


# ---------------------------------------------------------------- Spark side
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _fixed_model(START).assign(_points(spark, sf_dir), keys=KEYS)
    return a.select(*KEYS, *NAMES, "cluster", _r(F.col("d2")).alias("d2"))


def kmeans_assign_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _fixed_model(START).assign(_points(spark, sf_dir), keys=KEYS)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("number_of_points"),
                                    *[_r(F.avg(n)).alias(n) for n in NAMES])


def kmeans_lloyd_3iter(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = kmeans_fit(_points(spark, sf_dir), NAMES, K, keys=KEYS, init=START, tol=-1.0, max_iter=3,
                   spread_input=True)
    return _centres_table(spark, m)


def kmeans_iteration_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _fit(spark, sf_dir)
    return m.iteration_log_df(spark).select("iteration", _r(F.col("movement")).alias("movement"))


def kmeans_fit_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _centres_table(spark, _fit(spark, sf_dir), with_iterations=True)


def kmeans_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _points(spark, sf_dir)
    m = _fit(spark, sf_dir)
    m.report(df, KEYS)
    # Times differ on every run; the query tells which metrics hold one.
    recorded = F.col("metric").isin(list(m.timings)) & (F.col("time_ms") >= 0)
    return m.timings_df(spark).select("metric", recorded.alias("recorded"))


SQL_TIMINGS = "SELECT metric, true AS recorded FROM (VALUES " + ", ".join(
    f"('{m}')" for m in TIMING_METRICS) + ") AS t(metric)"


def cluster_stats_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _fit(spark, sf_dir)
    s = m.cluster_stats(_points(spark, sf_dir), around="centre")
    return s.select("cluster", "number_of_points", _r(F.col("dispersion")).alias("dispersion"))


def cluster_stats_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _fit(spark, sf_dir)
    s = m.cluster_stats(_points(spark, sf_dir), around="mean")
    return s.select("cluster", "number_of_points",
                    *[_r(F.col(f"centroid_{n}")).alias(f"centroid_{n}") for n in NAMES],
                    _r(F.col("dispersion")).alias("dispersion"))


def inter_cluster_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _fit(spark, sf_dir)
    return m.inter_cluster_distances(spark).select(
        "cluster_1", "cluster_2", _r(F.col("distance")).alias("distance"))


def cluster_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _points(spark, sf_dir)
    m = _fit(spark, sf_dir)
    m.register_views(df, keys=KEYS, prefix="")
    return spark.sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, x, y, cluster, "
        f"round(d2, {FITTED_D2_DIGITS}) AS d2 FROM cluster_assignments")


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _points(spark, sf_dir)
    m = _fit(spark, sf_dir)
    m.register_views(df, keys=KEYS, prefix="")
    return spark.sql("SELECT cluster, round(x, 6) AS x, round(y, 6) AS y FROM centroids")


def sample_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts, _ = project_points(_points(spark, sf_dir), NAMES, KEYS)
    return sample_by_hash(pts, KEYS, 10, SEED, tie_cols=NAMES)


def sample_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _fit(spark, sf_dir)
    return m.sample_assignments(_points(spark, sf_dir), KEYS, 10, SEED)


def kmeanspp_min_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _points(spark, sf_dir)
    md = min_sq_distance([F.col(n) for n in NAMES], START)
    return df.select(*KEYS, *NAMES, _r(md).alias("min_d2"))


def _cumulative(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(running totals, weights)``: the second is the plain weight column of the scan.

    One aggregate over the scan finds the first centre, the row count and
    whether equal slices of ``u`` are even; the rows are then read once more
    (twice with crowded slices, for the range bounds) and shuffled once.
    """
    u = hash_uniform(KEYS, SEED, 1)
    raw = spread(_points(spark, sf_dir).withColumn("_rid", F.monotonically_increasing_id()))
    seen = raw.groupBy(u_slices(u)).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(hash_uniform(KEYS, SEED, 0).alias("u"), *NAMES)).alias("first")).collect()
    if not seen:
        raise ValueError("no rows to weigh")
    first = min(tuple(r["first"]) for r in seen)[1:]
    counts = [r["n"] for r in seen]
    buckets = bucket_count(spark, sum(counts))
    w = sq_distance([F.col(n) for n in NAMES], first)
    data = raw.select(*KEYS, *NAMES, w.alias("w"), u.alias("u"), "_rid")
    # order: u, then keys, then coordinates (a duplicated key stays ordered)
    cum = running_total(data, "w", "u", [*KEYS, *NAMES], buckets=buckets, tie="_rid",
                        even=evenly_sliced(counts, buckets))
    return cum, raw.select(w.alias("w"))


def kmeanspp_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    cum = _cumulative(spark, sf_dir)[0]
    return cum.select(*KEYS, *NAMES, "u", _r(F.col("w")).alias("w"),
                      *[F.expr(significant(c)).alias(c) for c in ("cum_before", "cum_through")])


THRESHOLD_R = scalar_uniform(SEED, "threshold")


def kmeanspp_threshold_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    cum, weights = _cumulative(spark, sf_dir)
    total = weights.agg(F.sum("w")).collect()[0][0] or 0.0
    d = threshold_draw(cum, "w", "u", [*KEYS, *NAMES], THRESHOLD_R, total=total)
    return d.select(*KEYS, *NAMES, F.expr(significant("cum_through")).alias("cum_through"))


def kmeanspp_init_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts, _ = project_points(_points(spark, sf_dir), NAMES, KEYS)
    seeds = kmeanspp_init(spread(pts), KEYS, NAMES, K, SEED)
    schema = T.StructType([T.StructField("seed_order", T.IntegerType(), False)]
                          + [T.StructField(n, T.DoubleType(), False) for n in NAMES])
    return spark.createDataFrame([(i, *c) for i, c in enumerate(seeds)], schema)


def kmeanspp_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _centres_table(spark, _fit(spark, sf_dir, init="k-means++"), with_iterations=True)


def kmeans_vector_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points as one ML vector column with four zeros appended: sparse where
    the line number is even (the assembler's choice for mostly zeros), else dense."""
    zeros = [F.lit(0.0).alias(f"zero_{j}") for j in range(4)]
    pts = _points(spark, sf_dir).select("*", *zeros)
    wide = VectorAssembler(inputCols=[*NAMES, *[f"zero_{j}" for j in range(4)]], outputCol="sparse").transform(pts)
    wide = wide.withColumn("point", F.when(F.col("l_linenumber") % 2 == 0, F.col("sparse")).otherwise(
        array_to_vector(F.concat(F.array(*NAMES), F.array_repeat(F.lit(0.0), 4)))))
    start = [(*c, 0.0, 0.0, 0.0, 0.0) for c in START]
    names = [f"point_{j}" for j in range(len(start[0]))]
    model = KMeansModel(names=names, centres=start, init_centres=start, iterations=0, converged=False)
    a = model.assign(wide, features="point", keys=KEYS)
    return a.select(*KEYS, "cluster", _r(F.col("d2")).alias("d2"))


def embedding_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector ``e``: ``2e``, ``e + 2e`` and ``(e + 2e) - e/2``, each by its dot product with ``e``."""
    e = F.col("embedding").cast("array<double>")
    twice = array_scale(2.0, e)
    total = array_add(e, twice)
    less = array_subtract(total, array_scale(0.5, e))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", _r(array_dot(e, twice)).alias("dot_scaled"), _r(array_dot(e, total)).alias("dot_sum"),
        _r(array_dot(e, less)).alias("dot_difference"))


def kmeans_embeddings_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    m = kmeans_fit(emb, "embedding", EMB_K, keys=["vec_id"], init="random", tol=-1.0,
                   max_iter=EMB_ITERS, seed=SEED, spread_input=True)
    return _centres_long(spark, m)


def _centres_long(spark: SparkSession, m: KMeansModel) -> DataFrame:
    rows = [(i, j, float(v)) for i, c in enumerate(m.centres) for j, v in enumerate(c)]
    schema = T.StructType([T.StructField("cluster", T.IntegerType(), False),
                           T.StructField("dim", T.IntegerType(), False),
                           T.StructField("value", T.DoubleType(), False)])
    return spark.createDataFrame(rows, schema).select("cluster", "dim", _r(F.col("value")).alias("value"))


def kmeans_embeddings_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide fit to convergence, however many iterations that takes (the SQL is unrolled to ``EMB_MAX_ITER``)."""
    m = kmeans_fit(table(spark, sf_dir, "embeddings"), "embedding", EMB_K, keys=["vec_id"], init="random",
                   tol=EMB_TOL, max_iter=None, seed=SEED, spread_input=True)
    return _centres_long(spark, m).withColumn("iterations", F.lit(m.iterations))


def kmeans_many_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred centres over (price, quantity) of lineitem, with distance bounds."""
    li = table(spark, sf_dir, "lineitem").select(
        *KEYS, (F.col("l_extendedprice") / MANY_UNIT).alias("x"), F.col("l_quantity").alias("y"))
    return _centres_long(spark, kmeans_fit(li, NAMES, MANY_K, keys=KEYS, init="random", tol=-1.0,
                                           max_iter=MANY_ITERS, seed=SEED, spread_input=True))


# ---------------------------------------------------------------- SQL side
PTS = ("pts AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
       "l_quantity AS x, l_discount * CAST('100.0' AS DOUBLE) AS y FROM lineitem)")
KEYCOLS = ", ".join(KEYS)


def _sql_random_fit() -> list[str]:
    return ([PTS] + random_init_ctes("c0", "pts", KEYS, NAMES, K, SEED)
            + lloyd_ctes("pts", NAMES, K, MAX_ITER) + converged_ctes(MAX_ITER, TOL))


def _sql_assign(centres: str) -> str:
    return (f"SELECT p.*, ({nearest_sql('p', 'o', NAMES, K)}) AS nn FROM pts p, {centres} o")


SQL: dict[str, str] = {}

SQL["kmeans_assign"] = with_(
    [PTS, literal_centres_cte("c0", NAMES, START)],
    f"SELECT {KEYCOLS}, x, y, nn.cluster AS cluster, round(nn.d2, 6) AS d2 FROM ({_sql_assign('c0')})")

SQL["kmeans_assign_step"] = with_(
    [PTS, literal_centres_cte("c0", NAMES, START)],
    f"SELECT nn.cluster AS cluster, count(*) AS number_of_points, round(avg(x), 6) AS x, "
    f"round(avg(y), 6) AS y FROM ({_sql_assign('c0')}) GROUP BY nn.cluster")

SQL["kmeans_lloyd_3iter"] = with_(
    [PTS, literal_centres_cte("c0", NAMES, START)] + lloyd_ctes("pts", NAMES, K, 3),
    centres_long("c3", NAMES, K))

SQL["kmeans_iteration_log"] = with_(
    _sql_random_fit(),
    "SELECT h.iteration, round(h.movement, 6) AS movement FROM hist h, fin f WHERE h.iteration <= f.it")

SQL["kmeans_fit_converged"] = with_(
    _sql_random_fit(),
    f"SELECT c.*, f.it AS iterations FROM ({centres_long('cf', NAMES, K)}) c, fin f")

SQL["cluster_stats_centre"] = with_(
    _sql_random_fit(),
    f"SELECT nn.cluster AS cluster, count(*) AS number_of_points, round(avg(nn.d2), 6) AS dispersion "
    f"FROM ({_sql_assign('cf')}) GROUP BY nn.cluster")

SQL["cluster_stats_mean"] = with_(
    _sql_random_fit(),
    f"SELECT nn.cluster AS cluster, count(*) AS number_of_points, round(avg(x), 6) AS centroid_x, "
    f"round(avg(y), 6) AS centroid_y, round(var_pop(x) + var_pop(y), 6) AS dispersion "
    f"FROM ({_sql_assign('cf')}) GROUP BY nn.cluster")

SQL["inter_cluster_distance"] = with_(
    _sql_random_fit() + [f"cl AS ({centres_long('cf', NAMES, K, digits=None)})"],
    "SELECT a.cluster AS cluster_1, b.cluster AS cluster_2, "
    "round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS distance "
    "FROM cl a JOIN cl b ON a.cluster < b.cluster")

SQL["cluster_assignments"] = with_(
    _sql_random_fit(),
    f"SELECT {KEYCOLS}, x, y, nn.cluster AS cluster, round(nn.d2, {FITTED_D2_DIGITS}) AS d2 "
    f"FROM ({_sql_assign('cf')})")

SQL["centroids"] = with_(_sql_random_fit(), centres_long("cf", NAMES, K))

_U = hash_uniform_sql(KEYS, SEED)
SQL["sample_points"] = with_(
    [PTS], f"SELECT *, {_U} AS u FROM pts ORDER BY u, {KEYCOLS}, x, y LIMIT 10")

SQL["sample_assignments"] = with_(
    _sql_random_fit() + [f"smp AS (SELECT * FROM pts ORDER BY {_U}, {KEYCOLS}, x, y LIMIT 10)"],
    f"SELECT {KEYCOLS}, x, y, ({nearest_sql('p', 'o', NAMES, K)}).cluster AS cluster FROM smp p, cf o")

_MD = "least(" + ", ".join(d2_sql("p", NAMES, [dbl(v) for v in c]) for c in START) + ")"
SQL["kmeanspp_min_distance"] = with_([PTS], f"SELECT {KEYCOLS}, x, y, round({_MD}, 6) AS min_d2 FROM pts p")

_CUM = [
    PTS,
    f"k0 AS MATERIALIZED (SELECT x AS {ccol('x', 0)}, y AS {ccol('y', 0)} FROM "
    f"(SELECT *, {hash_uniform_sql(KEYS, SEED, 0)} AS u FROM pts) ORDER BY u, x, y LIMIT 1)",
    f"wt AS MATERIALIZED (SELECT p.*, {d2_sql('p', NAMES, ['k.' + ccol('x', 0), 'k.' + ccol('y', 0)])} AS w, "
    f"{hash_uniform_sql(['p.' + k for k in KEYS], SEED, 1)} AS u FROM pts p, k0 k)",
    f"cum AS MATERIALIZED (SELECT *, coalesce(sum(w) OVER (ORDER BY u, {KEYCOLS}, x, y ROWS BETWEEN "
    f"UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS cum_before, sum(w) OVER (ORDER BY u, {KEYCOLS}, x, y "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_through FROM wt)",
]
SQL["kmeanspp_cumulative"] = with_(
    _CUM, f"SELECT {KEYCOLS}, x, y, u, round(w, 6) AS w, {significant('cum_before')} AS cum_before, "
          f"{significant('cum_through')} AS cum_through FROM cum")
SQL["kmeanspp_threshold_draw"] = with_(
    _CUM, f"SELECT {KEYCOLS}, x, y, {significant('cum_through')} AS cum_through FROM cum WHERE cum_through >= {dbl(THRESHOLD_R)} * "
          f"(SELECT sum(w) FROM wt) ORDER BY u, {KEYCOLS}, x, y LIMIT 1")

SQL["kmeanspp_init"] = with_(
    [PTS] + kmeanspp_ctes("c0", "pts", KEYS, NAMES, K, SEED),
    " UNION ALL ".join(f"SELECT {i} AS seed_order, {ccol('x', i)} AS x, {ccol('y', i)} AS y FROM c0"
                       for i in range(K)))

SQL["kmeanspp_fit"] = with_(
    [PTS] + kmeanspp_ctes("c0", "pts", KEYS, NAMES, K, SEED) + lloyd_ctes("pts", NAMES, K, MAX_ITER)
    + converged_ctes(MAX_ITER, TOL),
    f"SELECT c.*, f.it AS iterations FROM ({centres_long('cf', NAMES, K)}) c, fin f")

_EN = [f"embedding_{j}" for j in range(EMB_DIM)]
_EPTS = ("epts AS MATERIALIZED (SELECT vec_id, "
         + ", ".join(f"CAST(embedding[{j + 1}] AS DOUBLE) AS embedding_{j}" for j in range(EMB_DIM))
         + " FROM embeddings)")
SQL["kmeans_embeddings_step"] = with_(
    [_EPTS] + random_init_ctes("c0", "epts", ["vec_id"], _EN, EMB_K, SEED)
    + lloyd_ctes("epts", _EN, EMB_K, EMB_ITERS),
    wide_to_long(f"c{EMB_ITERS}", _EN, EMB_K))


_LIST_HIST = " UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(1, EMB_MAX_ITER + 1))
_LIST_ALL = " UNION ALL ".join(f"SELECT {i} AS it, * FROM c{i}" for i in range(1, EMB_MAX_ITER + 1))
SQL["kmeans_embeddings_fit"] = with_(
    ["epts AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)",
     *list_lloyd_ctes("epts", ["vec_id"], EMB_K, SEED, EMB_MAX_ITER),
     f"fin AS MATERIALIZED (SELECT min(iteration) AS it FROM ({_LIST_HIST}) WHERE movement <= {dbl(EMB_TOL)})",
     f"cf AS MATERIALIZED (SELECT c.*, CAST(c.it AS INTEGER) AS iterations FROM ({_LIST_ALL}) c, fin "
     "WHERE c.it = fin.it)"],
    list_centres_long("cf", ", iterations"))
SQL["kmeans_many_centres"] = with_(
    [f"mpts AS MATERIALIZED (SELECT {KEYCOLS}, row_number() OVER () AS rid, [l_extendedprice / {dbl(MANY_UNIT)}, l_quantity] AS e FROM lineitem)",
     *list_lloyd_ctes("mpts", KEYS, MANY_K, SEED, MANY_ITERS)],
    list_centres_long(f"c{MANY_ITERS}"))

SQL["kmeans_vector_assign"] = with_(
    [PTS, literal_centres_cte("c0", NAMES, START)],
    f"SELECT {KEYCOLS}, nn.cluster AS cluster, round(nn.d2, 6) AS d2 FROM ({_sql_assign('c0')})")

_DE = "CAST(embedding AS DOUBLE[])"
SQL["embedding_arithmetic"] = (
    "SELECT vec_id, " + ", ".join(
        f"round(list_sum(list_transform({_DE}, lambda x: x * {v})), 6) AS {n}" for n, v in [
            ("dot_scaled", "(2.0::DOUBLE * x)"), ("dot_sum", "(x + 2.0::DOUBLE * x)"),
            ("dot_difference", "((x + 2.0::DOUBLE * x) - 0.5::DOUBLE * x)")]) + " FROM embeddings")

SQL["kmeans_timings"] = SQL_TIMINGS


QUERIES = {
    "kmeans_assign": kmeans_assign,
    "kmeans_assign_step": kmeans_assign_step,
    "kmeans_lloyd_3iter": kmeans_lloyd_3iter,
    "kmeans_iteration_log": kmeans_iteration_log,
    "kmeans_fit_converged": kmeans_fit_converged,
    "kmeans_timings": kmeans_timings,
    "cluster_stats_centre": cluster_stats_centre,
    "cluster_stats_mean": cluster_stats_mean,
    "inter_cluster_distance": inter_cluster_distance,
    "cluster_assignments": cluster_assignments,
    "centroids": centroids,
    "sample_points": sample_points,
    "sample_assignments": sample_assignments,
    "kmeanspp_min_distance": kmeanspp_min_distance,
    "kmeanspp_cumulative": kmeanspp_cumulative,
    "kmeanspp_threshold_draw": kmeanspp_threshold_draw,
    "kmeanspp_init": kmeanspp_init_query,
    "kmeanspp_fit": kmeanspp_fit,
    "kmeans_embeddings_step": kmeans_embeddings_step,
    "kmeans_embeddings_fit": kmeans_embeddings_fit,
    "kmeans_many_centres": kmeans_many_centres,
    "kmeans_vector_assign": kmeans_vector_assign,
    "embedding_arithmetic": embedding_arithmetic,
}
