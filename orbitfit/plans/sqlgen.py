"""DuckDB SQL builders for the independent oracle of each registered query.

The oracle recomputes every result from the raw tables in plain SQL: no
Spark, no NumPy, no shared code path except the fixed hashing formula. An
iterative fit becomes a chain of ``MATERIALIZED`` CTEs, one per iteration,
each holding the centres as one wide row; arithmetic is written in the same
order as the Spark expressions so both engines round the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from orbitfit.functions.random import hash_uniform_sql


def dbl(v: float) -> str:
    """An exact DOUBLE literal (parsed from the shortest round-trip text)."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def ccol(name: str, i: int) -> str:
    """Column of dimension ``name`` of centre ``i`` in a wide centre row."""
    return f"{name}__{i}"


def d2_sql(p: str, names: Sequence[str], centre: Sequence[str]) -> str:
    """``(p.x - c) * (p.x - c) + ...`` left to right."""
    terms = [f"({p}.{n} - {c}) * ({p}.{n} - {c})" for n, c in zip(names, centre)]
    return " + ".join(terms)


def centre_refs(alias: str, names: Sequence[str], i: int) -> list[str]:
    return [f"{alias}.{ccol(n, i)}" for n in names]


def nearest_sql(p: str, c: str, names: Sequence[str], k: int) -> str:
    """``least`` over ``{d2, cluster}`` structs: ties go to the lowest index."""
    parts = [f"{{'d2': {d2_sql(p, names, centre_refs(c, names, i))}, 'cluster': {i}}}"
             for i in range(k)]
    return parts[0] if k == 1 else "least(" + ", ".join(parts) + ")"


def literal_centres_cte(name: str, names: Sequence[str], centres: Sequence[Sequence[float]]) -> str:
    cols = [f"{dbl(v)} AS {ccol(n, i)}" for i, c in enumerate(centres) for n, v in zip(names, c)]
    return f"{name} AS MATERIALIZED (SELECT {', '.join(cols)})"


def random_init_ctes(name: str, pts: str, keys: Sequence[str], names: Sequence[str], k: int,
                     seed: int) -> list[str]:
    """K-point seeded sample in ``(u, keys, features)`` order, as one wide row."""
    order = ", ".join(["u", *keys, *names])
    u = hash_uniform_sql(keys, seed)
    smp = (f"{name}_smp AS MATERIALIZED (SELECT {', '.join(names)}, "
           f"row_number() OVER (ORDER BY {order}) - 1 AS rn FROM "
           f"(SELECT *, {u} AS u FROM {pts} ORDER BY {order} LIMIT {k}))")
    cols = [f"max({n}) FILTER (WHERE rn = {i}) AS {ccol(n, i)}" for i in range(k) for n in names]
    return [smp, f"{name} AS MATERIALIZED (SELECT {', '.join(cols)} FROM {name}_smp)"]


def kmeanspp_ctes(name: str, pts: str, keys: Sequence[str], names: Sequence[str], k: int,
                  seed: int) -> list[str]:
    """Distance-squared seeding: round 0 smallest uniform; round r the smallest
    ``-ln(u_r) / min_d2`` among points with ``min_d2 > 0``."""
    ctes = []
    u0 = hash_uniform_sql(keys, seed, 0)
    sel0 = ", ".join(f"{n} AS {ccol(n, 0)}" for n in names)
    ctes.append(f"{name}_k0 AS MATERIALIZED (SELECT {sel0} FROM "
                f"(SELECT *, {u0} AS u FROM {pts}) ORDER BY u, {', '.join(names)} LIMIT 1)")
    for r in range(1, k):
        ds = [d2_sql("p", names, [f"k{i}.{ccol(n, i)}" for n in names]) for i in range(r)]
        md = ds[0] if r == 1 else "least(" + ", ".join(ds) + ")"
        ur = hash_uniform_sql([f"p.{kk}" for kk in keys], seed, r)
        frm = ", ".join([f"{pts} p"] + [f"{name}_k{i} k{i}" for i in range(r)])
        sel = ", ".join(f"{n} AS {ccol(n, r)}" for n in names)
        ctes.append(
            f"{name}_k{r} AS MATERIALIZED (SELECT {sel} FROM (SELECT "
            f"{', '.join('p.' + n for n in names)}, {md} AS md, {ur} AS u FROM {frm}) "
            f"WHERE md > 0 ORDER BY (-ln(u)) / md, {', '.join(names)} LIMIT 1)")
    ctes.append(f"{name} AS MATERIALIZED (SELECT * FROM "
                + ", ".join(f"{name}_k{i}" for i in range(k)) + ")")
    return ctes


def lloyd_ctes(pts: str, names: Sequence[str], k: int, n_iter: int, start: str = "c0",
               prefix: str = "") -> list[str]:
    """``n_iter`` Lloyd iterations from the wide centre row ``start``.

    Produces, per iteration i: ``{prefix}a{i}`` assignments, ``{prefix}s{i}``
    sums, ``{prefix}c{i}`` centres (empty cluster keeps its centre) and
    ``{prefix}m{i}`` the total squared movement.
    """
    ctes = []
    prev = start
    for i in range(1, n_iter + 1):
        a, s, c, m = (f"{prefix}{x}{i}" for x in "ascm")
        ctes.append(f"{a} AS MATERIALIZED (SELECT ({nearest_sql('p', 'o', names, k)}).cluster AS cluster, "
                    f"{', '.join('p.' + n for n in names)} FROM {pts} p, {prev} o)")
        ctes.append(f"{s} AS MATERIALIZED (SELECT cluster, count(*) AS n, "
                    f"{', '.join(f'sum({n}) AS {n}' for n in names)} FROM {a} GROUP BY cluster)")
        cols = [f"coalesce(max(s.{n} / s.n) FILTER (WHERE s.cluster = {j}), min(o.{ccol(n, j)})) "
                f"AS {ccol(n, j)}" for j in range(k) for n in names]
        ctes.append(f"{c} AS MATERIALIZED (SELECT {', '.join(cols)} FROM {prev} o LEFT JOIN {s} s ON TRUE)")
        per = []
        for j in range(k):
            dd = [f"(o.{ccol(n, j)} - c.{ccol(n, j)}) * (o.{ccol(n, j)} - c.{ccol(n, j)})" for n in names]
            per.append("(" + " + ".join(dd) + ")")
        ctes.append(f"{m} AS MATERIALIZED (SELECT {i} AS iteration, {' + '.join(per)} AS movement "
                    f"FROM {prev} o, {c} c)")
        prev = c
    return ctes


def converged_ctes(n_iter: int, tol: float, prefix: str = "", out: str = "cf") -> list[str]:
    """First iteration with movement <= tol (else the last); its centres as ``out``."""
    hist = " UNION ALL ".join(f"SELECT * FROM {prefix}m{i}" for i in range(1, n_iter + 1))
    allc = " UNION ALL ".join(f"SELECT {i} AS it, * FROM {prefix}c{i}" for i in range(1, n_iter + 1))
    return [
        f"{prefix}hist AS MATERIALIZED ({hist})",
        f"{prefix}fin AS MATERIALIZED (SELECT coalesce(min(iteration) FILTER (WHERE movement <= "
        f"{dbl(tol)}), {n_iter}) AS it FROM {prefix}hist)",
        f"{out} AS MATERIALIZED (SELECT cc.* EXCLUDE (it) FROM ({allc}) cc, {prefix}fin f "
        f"WHERE cc.it = f.it)",
    ]


def centres_long(wide: str, names: Sequence[str], k: int, out_names: Sequence[str] | None = None,
                 digits: int | None = 6) -> str:
    """``(cluster, dims...)`` rows from a wide centre row."""
    out_names = list(out_names or names)
    parts = []
    for i in range(k):
        cols = ", ".join((f"round({wide}.{ccol(n, i)}, {digits})" if digits is not None
                          else f"{wide}.{ccol(n, i)}") + f" AS {o}" for n, o in zip(names, out_names))
        parts.append(f"SELECT {i} AS cluster, {cols} FROM {wide}")
    return " UNION ALL ".join(parts)


def with_(ctes: Sequence[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def wide_to_long(wide: str, names: Sequence[str], k: int, digits: int = 6) -> str:
    """``(cluster, dim, value)`` rows of a wide centre row, via parallel unnest."""
    cl = ", ".join(str(i) for i in range(k) for _ in names)
    dm = ", ".join(str(j) for _ in range(k) for j in range(len(names)))
    vs = ", ".join(f"{wide}.{ccol(n, i)}" for i in range(k) for n in names)
    return (f"SELECT CAST(cluster AS INTEGER) AS cluster, CAST(dim AS INTEGER) AS dim, "
            f"round(value, {digits}) AS value FROM (SELECT unnest([{cl}]) AS cluster, "
            f"unnest([{dm}]) AS dim, unnest([{vs}]) AS value FROM {wide})")


def significant(v: str, digits: int = 9) -> str:
    """``v`` rounded to significant digits, the same text for both engines: it only multiplies and
    divides by powers of ten that doubles hold exactly."""
    k = f"(floor(log10(abs({v}))) - {digits - 1})"
    return (f"CASE WHEN {v} = 0 THEN 0.0 WHEN {k} >= 0 THEN round({v} / pow(10, {k})) * pow(10, {k}) "
            f"ELSE round({v} * pow(10, -{k})) / pow(10, -{k}) END")


def list_lloyd_ctes(pts: str, keys: Sequence[str], k: int, seed: int, n_iter: int) -> list[str]:
    """``n_iter`` Lloyd iterations over points ``e`` (lists, numbered ``rid``) from a seeded K-point sample: centre tables
    ``c{i}(cluster, e)`` in long form and ``m{i}``, the total squared movement."""
    order = ", ".join(["u", *keys, "e"])
    ctes = [f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS cluster, e FROM "
            f"(SELECT *, {hash_uniform_sql(keys, seed)} AS u FROM {pts} ORDER BY {order} LIMIT {k}))"]
    for i in range(1, n_iter + 1):
        ctes.append(f"a{i} AS MATERIALIZED (SELECT (min({{'d': list_distance(p.e, c.e), 'c': c.cluster}})).c AS cluster, "
                    f"any_value(p.e) AS e FROM {pts} p, c{i - 1} c GROUP BY p.rid)")
        ctes.append(f"s{i} AS MATERIALIZED (SELECT cluster, list(v ORDER BY j) AS e FROM (SELECT cluster, j, avg(v) AS v "
                    f"FROM (SELECT cluster, unnest(e) AS v, generate_subscripts(e, 1) AS j FROM a{i}) "
                    "GROUP BY cluster, j) GROUP BY cluster)")
        ctes.append(f"c{i} AS MATERIALIZED (SELECT o.cluster, coalesce(s.e, o.e) AS e FROM c{i - 1} o LEFT JOIN s{i} s "
                    "ON o.cluster = s.cluster)")
        ctes.append(f"m{i} AS MATERIALIZED (SELECT {i} AS iteration, sum(list_distance(o.e, c.e) * list_distance(o.e, c.e)) "
                    f"AS movement FROM c{i - 1} o JOIN c{i} c ON o.cluster = c.cluster)")
    return ctes


def list_centres_long(wide: str, extra: str = "") -> str:
    """``(cluster, dim, value)`` rows of a long centre table."""
    return (f"SELECT cluster, CAST(j - 1 AS INTEGER) AS dim, round(v, 6) AS value{extra} FROM (SELECT *, "
            f"unnest(e) AS v, generate_subscripts(e, 1) AS j FROM {wide})")
