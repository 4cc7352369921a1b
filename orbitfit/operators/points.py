"""Point projection (P1-P4): pick feature columns, apply the NULL/NaN policy.

Only the key and feature columns are selected, so the parquet scan reads
just those columns (``ReadSchema`` shows them) before anything is cached.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitfit.functions.vector import array_feature, check_valid, feature_columns, valid_array

Features = str | Sequence[str] | Mapping[str, Column]


def project_points(df: DataFrame, features: Features, keys: Sequence[str] = (),
                   invalid: str = "error", dim: int | None = None) -> tuple[DataFrame, list[str]]:
    """Return ``(points, names)``: keys plus one double column per dimension.

    ``features`` may be a list of numeric column names, a mapping of output
    name to expression, or the name of one array column (expanded to
    ``<name>_0 .. <name>_{d-1}``).
    """
    if isinstance(features, Mapping):
        names = list(features)
        exprs = [features[n].cast("double") for n in names]
    elif isinstance(features, str):
        exprs = feature_columns(df, features, dim)
        names = [f"{features}_{j}" for j in range(len(exprs))]
    else:
        names = list(features)
        exprs = feature_columns(df, names)
    guarded, keep = check_valid(exprs, invalid)
    out = df.select(*[F.col(k) for k in keys], *[e.alias(n) for e, n in zip(guarded, names)])
    if keep is not None:
        # the predicate refers to raw expressions; re-express on output names
        ok = None
        for n in names:
            c = F.col(n).isNotNull() & ~F.isnan(F.col(n))
            ok = c if ok is None else ok & c
        out = out.where(ok)
    return out, names


def project_array(df: DataFrame, feature: str, keys: Sequence[str] = (), invalid: str = "error",
                  dim: int | None = None) -> tuple[DataFrame, list[str]]:
    """``(points, names)`` with the points left in one array column, named ``feature``: a single
    guard expression and no column per dimension. ``names`` are those that
    :func:`project_points` would give the dimensions."""
    arr, dim = array_feature(df, feature, dim)
    arr, ok = valid_array(arr, dim, invalid)
    out = df if ok is None else df.where(ok)
    return out.select(*[F.col(k) for k in keys], arr.alias(feature)), [f"{feature}_{j}" for j in range(dim)]
