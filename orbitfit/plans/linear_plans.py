"""Registered linear-model queries (Spark) and their DuckDB oracles.

R = part: ``y = p_retailprice``, ``phi = (x, 1)`` with
``x = (p_partkey % 1000) / 10`` (so ``y = 900 + x``), ``seq = p_partkey`` and
``shard = floor(p_partkey / 100)``: contiguous shards of 100 rows, as the
reference's ten slices of 100. The ``*_epoch`` and ``*_lineitem`` fits run on all of
lineitem in three shards of a third of the rows each, and its numerics feed the
moment queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.functions.random import hash_uniform_sql
from orbitfit.operators.linear import (
    column_moments as _column_moments, full_batch_history, gradient, mse, normal_stats,
    normal_stats_table, standardize as _standardize,
)
from orbitfit.operators.momentum import FitResult, heavy_ball, local_sgd, nesterov
from orbitfit.plans.sqlgen import dbl, significant, with_
from orbitfit.sources.tables import LINEITEM_KEYS, LINEITEM_ORDER, lineitem_regression, part_regression, table

# Fixed parameters of the registered linear-model queries.
MOMENT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
W_FIXED = (0.9, 905.0)
FB_EPOCHS, FB_S0, FB_DECAY, FB_MOMENTUM = 20, 0.1, 0.01, 0.6
SH_S0, SH_DECAY, SH_MOMENTUM, SH_SEED = 1e-7, 0.01, 0.6, 42
HISTORY_EPOCHS = 50
LI_EPOCHS, LI_S0 = 10, 1e-4
PHI = ["x", "bias"]

# Output precision, both engines: losses and sums are compared on nine
# significant digits (``significant``), weights to 6 decimals.
MOMENT_DIGITS = 5


def _r(c, digits: int = 6):
    return F.round(c, digits)


def _rr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_regression(spark, sf_dir)


# ---------------------------------------------------------------- Spark side
def column_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _column_moments(table(spark, sf_dir, "lineitem"), MOMENT_COLS)
    return m.select(F.col("column").alias("column_name"), "n",
                    _r(F.col("mean"), MOMENT_DIGITS).alias("mean"),
                    _r(F.col("stddev"), MOMENT_DIGITS).alias("stddev"))


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, _, _ = _standardize(table(spark, sf_dir, "lineitem"), MOMENT_COLS, keep=LINEITEM_KEYS)
    return s.select(*LINEITEM_KEYS, *[_r(F.col(c)).alias(c) for c in MOMENT_COLS])


def linear_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rr(spark, sf_dir)
    return r.agg(_r(mse(r, "y", PHI, W_FIXED)).alias("mse"))


def linear_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rr(spark, sf_dir)
    g = r.agg(*[c.alias(f"g{j}") for j, c in enumerate(gradient(r, "y", PHI, W_FIXED))])
    rows = F.array(*[F.struct(F.lit(j).alias("component"), _r(F.col(f"g{j}")).alias("value"))
                     for j in range(len(PHI))])
    return g.select(F.inline(rows))


def normal_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = normal_stats_table(_rr(spark, sf_dir), "y", PHI)
    return t.select("i", "j", F.expr(significant("value")).alias("value"))


def _standardised_r(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, _, _ = _standardize(_rr(spark, sf_dir), ["x"], keep=["y", "bias"])
    return s


_HIST_FIELDS = ["epoch", "step", "slope", "intercept", "velocity_slope", "velocity_intercept", "loss"]


def _history_df(spark: SparkSession, rows: list[tuple], with_velocity: bool) -> DataFrame:
    fields = [T.StructField("epoch", T.IntegerType(), False)] + [
        T.StructField(n, T.DoubleType(), False) for n in _HIST_FIELDS[1:]]
    df = spark.createDataFrame([(e, s, w0, w1, v0, v1, loss) for e, s, w0, w1, v0, v1, loss in rows],
                               T.StructType(fields))
    cols = [F.col("epoch"), _r(F.col("step"), 12).alias("step"), _r(F.col("slope")).alias("slope"),
            _r(F.col("intercept")).alias("intercept")]
    if with_velocity:
        cols += [_r(F.col("velocity_slope")).alias("velocity_slope"),
                 _r(F.col("velocity_intercept")).alias("velocity_intercept")]
    return df.select(*cols, F.expr(significant("loss")).alias("loss"))


def _full_batch(method: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stats = normal_stats(_standardised_r(spark, sf_dir), "y", PHI)
        h = full_batch_history(stats, method, FB_EPOCHS, FB_S0, FB_DECAY, FB_MOMENTUM)
        rows = [(e, s, w0, w1, v0, v1, loss) for e, s, w0, w1, v0, v1, loss in h]
        return _history_df(spark, rows, method != "gd")
    return run


def _sharded_rows(res: FitResult) -> list[tuple]:
    out = []
    for h in res.history:
        e, s, w0, w1 = h[0], h[1], h[2], h[3]
        if res.v:
            v0, v1 = h[4], h[5]
        else:
            v0 = v1 = 0.0
        out.append((e, s, w0, w1, v0, v1, h[-1]))
    return out


def _sharded(method: str, epochs: int, lineitem: bool = False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        r = lineitem_regression(spark, sf_dir) if lineitem else _rr(spark, sf_dir)
        order, s0 = (LINEITEM_ORDER, LI_S0) if lineitem else (["seq"], SH_S0)
        args = (r, "y", PHI, "shard", order, epochs, s0, SH_DECAY)
        if method == "heavy_ball":
            res = heavy_ball(*args, SH_MOMENTUM)
        elif method == "nesterov":
            res = nesterov(*args, SH_MOMENTUM)
        else:
            res = local_sgd(*args, seed=SH_SEED, permute="epoch",
                            combine="sequential" if method == "sgd_sequential" else "average")
        return _history_df(spark, _sharded_rows(res), method in ("heavy_ball", "nesterov"))
    return run


# Column and view of each history query, as the views name them.
_VIEWS = {
    "weight_history_view": ("weightHistoryView", ["slope", "intercept"]),
    "velocity_history_view": ("velocityHistoryView", ["velocity_slope", "velocity_intercept"]),
    "loss_history_view": ("lossHistoryView", ["loss"]),
}


def _history_view(view: str, columns: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        res = heavy_ball(_rr(spark, sf_dir), "y", PHI, "shard", ["seq"], HISTORY_EPOCHS, SH_S0, SH_DECAY, SH_MOMENTUM)
        res.register_views(spark, w_names=["slope", "intercept"],
                           v_names=["velocity_slope", "velocity_intercept"])
        shown = [(significant(c) if c == "loss" else f"round({c}, 6)") + f" AS {c}" for c in columns]
        return spark.sql(f"SELECT epoch, {', '.join(shown)} FROM {view}")
    return run


# ---------------------------------------------------------------- SQL side
_R = ("r AS MATERIALIZED (SELECT p_partkey AS seq, p_partkey // 100 AS shard, p_retailprice AS y, "
      "(p_partkey % 1000) / CAST('10.0' AS DOUBLE) AS x, CAST('1.0' AS DOUBLE) AS bias FROM part)")
_R_LINEITEM = ("r AS MATERIALIZED (SELECT " + ", ".join(LINEITEM_KEYS) + ", ascii(l_returnflag) AS shard, "
               "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS units, "
               "l_extendedprice / CAST('1000.0' AS DOUBLE) AS y, l_quantity / CAST('10.0' AS DOUBLE) AS x, "
               "CAST('1.0' AS DOUBLE) AS bias FROM lineitem)")
W0, W1 = dbl(W_FIXED[0]), dbl(W_FIXED[1])

SQL: dict[str, str] = {}

SQL["column_moments"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), {MOMENT_DIGITS}) AS mean, "
    f"round(stddev_pop({c}), {MOMENT_DIGITS}) AS stddev FROM lineitem" for c in MOMENT_COLS)

SQL["standardize"] = with_(
    ["m AS MATERIALIZED (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in MOMENT_COLS) + " FROM lineitem)"],
    "SELECT " + ", ".join(LINEITEM_KEYS) + ", " + ", ".join(
        f"round(CASE WHEN m.s_{c} = 0 THEN 0.0 ELSE (l.{c} - m.m_{c}) / m.s_{c} END, 6) AS {c}"
        for c in MOMENT_COLS) + " FROM lineitem l, m")

_DOT = f"({W0} * x + {W1} * bias)"
SQL["linear_mse"] = with_([_R], f"SELECT round(avg((y - {_DOT}) * (y - {_DOT})), 6) AS mse FROM r")
SQL["linear_gradient"] = with_(
    [_R, f"g AS (SELECT avg(x * (2.0 * ({_DOT} - y))) AS g0, avg(bias * (2.0 * ({_DOT} - y))) AS g1 FROM r)"],
    "SELECT 0 AS component, round(g0, 6) AS value FROM g UNION ALL "
    "SELECT 1 AS component, round(g1, 6) AS value FROM g")

SQL["normal_stats"] = with_(
    [_R, "s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(y * y) AS yy, sum(x * y) AS b0, sum(x * x) AS a00, "
         "sum(x * bias) AS a01, sum(bias * y) AS b1, sum(bias * bias) AS a11 FROM r)"],
    " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, {significant(v)} AS value FROM s" for i, j, v in
                       [(-1, -2, "n"), (-1, -1, "yy"), (0, -1, "b0"), (0, 0, "a00"), (0, 1, "a01"),
                        (1, -1, "b1"), (1, 1, "a11")]))


def _full_batch_sql(method: str) -> str:
    s0, dec, gam = dbl(FB_S0), dbl(FB_DECAY), dbl(FB_MOMENTUM)
    ctes = [
        _R,
        "mo AS MATERIALIZED (SELECT avg(x) AS mx, stddev_pop(x) AS sx FROM r)",
        "z AS MATERIALIZED (SELECT (r.x - mo.mx) / mo.sx AS x, r.bias, r.y FROM r, mo)",
        "st AS MATERIALIZED (SELECT count(*) AS n, sum(x * x) AS a00, sum(x * bias) AS a01, "
        "sum(bias * bias) AS a11, sum(x * y) AS b0, sum(bias * y) AS b1, sum(y * y) AS yy FROM z)",
    ]
    if method == "nesterov":
        lw0, lw1 = f"(h.w0 - {gam} * h.v0)", f"(h.w1 - {gam} * h.v1)"
    else:
        lw0, lw1 = "h.w0", "h.w1"
    g0 = f"2.0 * ((st.a00 * {lw0} + st.a01 * {lw1}) - st.b0) / st.n"
    g1 = f"2.0 * ((st.a01 * {lw0} + st.a11 * {lw1}) - st.b1) / st.n"
    if method == "gd":
        upd = "q.w0 - q.s * q.g0 AS w0, q.w1 - q.s * q.g1 AS w1, q.v0 AS v0, q.v1 AS v1"
    else:
        upd = (f"q.w0 - ({gam} * q.v0 + q.s * q.g0) AS w0, q.w1 - ({gam} * q.v1 + q.s * q.g1) AS w1, "
               f"{gam} * q.v0 + q.s * q.g0 AS v0, {gam} * q.v1 + q.s * q.g1 AS v1")
    rec = (
        "h(epoch, step, w0, w1, v0, v1) AS (SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), "
        "CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) UNION ALL "
        f"SELECT q.e, q.s, {upd} FROM (SELECT h.epoch + 1 AS e, "
        f"{s0} / (1.0 + {dec} * (h.epoch + 1)) AS s, h.w0, h.w1, h.v0, h.v1, {g0} AS g0, {g1} AS g1 "
        f"FROM h, st WHERE h.epoch < {FB_EPOCHS}) q)"
    )
    residual = "(z.y - (h.w0 * z.x + h.w1 * z.bias))"
    vel = ("round(h.v0, 6) AS velocity_slope, round(h.v1, 6) AS velocity_intercept, "
           if method != "gd" else "")
    losses = (f"l AS MATERIALIZED (SELECT h.epoch, avg({residual} * {residual}) AS loss FROM h, z "
              "WHERE h.epoch > 0 GROUP BY h.epoch)")
    body = (f"SELECT h.epoch, round(h.step, 12) AS step, round(h.w0, 6) AS slope, round(h.w1, 6) AS intercept, "
            f"{vel}{significant('l.loss')} AS loss FROM h JOIN l ON h.epoch = l.epoch")
    return "WITH RECURSIVE " + ",\n".join(ctes + [rec, losses]) + "\n" + body


SQL["gd_full_history"] = _full_batch_sql("gd")
SQL["momentum_full_history"] = _full_batch_sql("heavy_ball")
SQL["nesterov_full_history"] = _full_batch_sql("nesterov")


def _sharded_sql(method: str, epochs: int, lineitem: bool = False) -> str:
    gam = dbl(SH_MOMENTUM)
    keys, s0 = (LINEITEM_ORDER, LI_S0) if lineitem else (["seq"], SH_S0)
    seq = ", ".join(keys)
    ctes = [_R_LINEITEM if lineitem else _R, "st0 AS MATERIALIZED (SELECT CAST(0.0 AS DOUBLE) AS w0, CAST(0.0 AS DOUBLE) AS w1, "
                "CAST(0.0 AS DOUBLE) AS v0, CAST(0.0 AS DOUBLE) AS v1)"]
    if method in ("heavy_ball", "nesterov"):
        ctes.append("g AS MATERIALIZED (SELECT shard, list({'x': x, 'y': y} ORDER BY " + seq + ") AS rows "
                    "FROM r GROUP BY shard)")
    for e in range(1, epochs + 1):
        s = dbl(s0 / (1.0 + SH_DECAY * e))
        prev = f"st{e - 1}"
        if method == "heavy_ball":
            gr = "(2.0 * ((acc.w0 * e.x + acc.w1 * 1.0) - e.y))"
            v0 = f"(acc.v0 * {gam} + (e.x * {gr}) * {s})"
            v1 = f"(acc.v1 * {gam} + (1.0 * {gr}) * {s})"
            lam = f"lambda acc, e: {{'w0': acc.w0 - {v0}, 'w1': acc.w1 - {v1}, 'v0': {v0}, 'v1': {v1}}}"
            init = "{'w0': p.w0, 'w1': p.w1, 'v0': p.v0, 'v1': p.v1}"
            ctes.append(f"f{e} AS MATERIALIZED (SELECT g.shard, list_reduce(g.rows, {lam}, {init}) AS z "
                        f"FROM g, {prev} p)")
            ctes.append(f"st{e} AS MATERIALIZED (SELECT avg(z.w0) AS w0, avg(z.w1) AS w1, avg(z.v0) AS v0, "
                        f"avg(z.v1) AS v1 FROM f{e})")
        elif method == "nesterov":
            gr = f"(2.0 * (((p.w0 - {gam} * p.v0) * e.x + (p.w1 - {gam} * p.v1) * 1.0) - e.y))"
            lam = (f"lambda acc, e: {{'v0': acc.v0 * {gam} + (e.x * {gr}) * {s}, "
                   f"'v1': acc.v1 * {gam} + (1.0 * {gr}) * {s}}}")
            init = "{'v0': p.v0, 'v1': p.v1}"
            ctes.append(f"f{e} AS MATERIALIZED (SELECT g.shard, p.w0 AS pw0, p.w1 AS pw1, "
                        f"list_reduce(g.rows, {lam}, {init}) AS z FROM g, {prev} p)")
            ctes.append(f"st{e} AS MATERIALIZED (SELECT avg(pw0 - z.v0) AS w0, avg(pw1 - z.v1) AS w1, "
                        f"avg(z.v0) AS v0, avg(z.v1) AS v1 FROM f{e})")
        elif method == "sgd_sequential":
            u = hash_uniform_sql(keys, SH_SEED, e)
            gr = "(2.0 * ((acc.w0 * e.x + acc.w1 * 1.0) - e.y))"
            lam = (f"lambda acc, e: {{'w0': acc.w0 - (e.x * {gr}) * {s}, "
                   f"'w1': acc.w1 - (1.0 * {gr}) * {s}}}")
            init = "{'w0': p.w0, 'w1': p.w1}"
            ctes.append(f"g{e} AS MATERIALIZED (SELECT list({{'x': x, 'y': y}} ORDER BY shard, u, {seq}) AS rows "
                        f"FROM (SELECT *, {u} AS u FROM r))")
            ctes.append(f"st{e} AS MATERIALIZED (SELECT z.w0 AS w0, z.w1 AS w1, CAST(0.0 AS DOUBLE) AS v0, "
                        f"CAST(0.0 AS DOUBLE) AS v1 FROM (SELECT list_reduce(g.rows, {lam}, {init}) AS z "
                        f"FROM g{e} g, {prev} p))")
        else:
            u = hash_uniform_sql(keys, SH_SEED, e)
            gr = "(2.0 * ((acc.w0 * e.x + acc.w1 * 1.0) - e.y))"
            lam = (f"lambda acc, e: {{'w0': acc.w0 - (e.x * {gr}) * {s}, "
                   f"'w1': acc.w1 - (1.0 * {gr}) * {s}}}")
            init = "{'w0': p.w0, 'w1': p.w1}"
            ctes.append(f"g{e} AS MATERIALIZED (SELECT shard, list({{'x': x, 'y': y}} ORDER BY u, {seq}) AS rows "
                        f"FROM (SELECT *, {u} AS u FROM r) GROUP BY shard)")
            ctes.append(f"f{e} AS MATERIALIZED (SELECT g.shard, list_reduce(g.rows, {lam}, {init}) AS z "
                        f"FROM g{e} g, {prev} p)")
            ctes.append(f"st{e} AS MATERIALIZED (SELECT avg(z.w0) AS w0, avg(z.w1) AS w1, "
                        f"CAST(0.0 AS DOUBLE) AS v0, CAST(0.0 AS DOUBLE) AS v1 FROM f{e})")
    parts = []
    for e in range(1, epochs + 1):
        ctes.append(f"l{e} AS MATERIALIZED (SELECT avg((y - (st.w0 * x + st.w1 * bias)) * (y - (st.w0 * x + "
                    f"st.w1 * bias))) AS loss FROM r, st{e} st)")
        s = dbl(s0 / (1.0 + SH_DECAY * e))
        vel = ("round(st.v0, 6) AS velocity_slope, round(st.v1, 6) AS velocity_intercept, "
               if method in ("heavy_ball", "nesterov") else "")
        parts.append(
            f"SELECT {e} AS epoch, round({s}, 12) AS step, round(st.w0, 6) AS slope, "
            f"round(st.w1, 6) AS intercept, {vel}"
            f"{significant(f'l{e}.loss')} AS loss FROM st{e} st, l{e}")
    return with_(ctes, " UNION ALL ".join(parts))


QUERIES = {
    "column_moments": column_moments,
    "standardize": standardize,
    "linear_mse": linear_mse,
    "linear_gradient": linear_gradient,
    "normal_stats": normal_stats_query,
    "gd_full_history": _full_batch("gd"),
    "momentum_full_history": _full_batch("heavy_ball"),
    "nesterov_full_history": _full_batch("nesterov"),
}
for _m, _name in (("heavy_ball", "heavy_ball"), ("nesterov", "nesterov"), ("sgd", "local_sgd"),
                  ("sgd_sequential", "sequential_sgd")):
    for _kind, _args in (("epoch", (1, True)), ("lineitem", (LI_EPOCHS, True)), ("history", (HISTORY_EPOCHS,))):
        QUERIES[f"{_name}_{_kind}"] = _sharded(_m, *_args)
        SQL[f"{_name}_{_kind}"] = _sharded_sql(_m, *_args)
for _name, _view in _VIEWS.items():
    QUERIES[_name] = _history_view(*_view)
    SQL[_name] = f"SELECT epoch, {', '.join(_view[1])} FROM ({SQL['heavy_ball_history']})"
