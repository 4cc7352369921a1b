"""Registered queries: Spark plans plus independent DuckDB oracle SQL."""

from orbitfit.plans import kmeans_plans, linear_plans, source_plans

_MODULES = (kmeans_plans, linear_plans, source_plans)


def all_queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def positive_zero_rounding(sql: str) -> str:
    """Rewrite every ``round(...)`` as ``(round(...) + 0.0)``.

    DuckDB's ``round`` keeps the sign of a value that rounds to zero
    (``-0.0``); Spark's never does. Adding ``0.0`` turns ``-0.0`` into
    ``0.0`` and leaves every other value unchanged.
    """
    out, i, token = [], 0, "round("
    while True:
        j = sql.find(token, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(token)])
            i = j + len(token)
            continue
        depth, k = 0, j + len(token) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = positive_zero_rounding(sql[j + len(token):k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1


def all_oracle_sql() -> dict:
    out = {}
    for m in _MODULES:
        out.update({k: positive_zero_rounding(v) for k, v in m.SQL.items()})
    return out
