"""Vector arithmetic as Spark column expressions.

A d-dimensional point is a list of ``double`` columns. Centres and weights
are small driver-side tuples inlined as literals, so every expression stays
inside whole-stage codegen (no Python UDF on the hot path).

Sums are built left to right with products, never ``pow``: the SQL oracle
builds the same expression tree and gets the same bits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Number = float | int
ColOrNum = Column | float | int


def _c(v: ColOrNum) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(float(v))


def _sum(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def feature_columns(df: DataFrame, cols: str | Sequence[str], dim: int | None = None) -> list[Column]:
    """Feature expressions as doubles.

    ``cols`` is a list of numeric column names, or the name of one array
    column (e.g. an embedding) or ML vector column (dense or sparse, as a
    ``VectorAssembler`` writes it; read with ``vector_to_array``); for an
    array or vector ``dim`` is its length. When it is not given, one aggregate
    reads the lengths and differing ones are an error; a row of another length
    than ``dim`` gives NULL features, which :func:`check_valid` rejects or drops.
    """
    if isinstance(cols, str):
        arr, dim = array_feature(df, cols, dim)
        return [F.when(F.size(arr) == dim, arr.getItem(j)).cast("double") for j in range(dim)]
    return [F.col(c).cast("double") for c in cols]


def array_feature(df: DataFrame, col: str, dim: int | None = None) -> tuple[Column, int]:
    """An array or ML vector column as an array, and the length of its values (see :func:`feature_columns`)."""
    arr = F.col(col)
    if _is_ml_vector(df.schema[col].dataType):
        from pyspark.ml.functions import vector_to_array
        arr = vector_to_array(arr, "float64")
    if dim is None:
        n = F.when(F.col(col).isNotNull(), F.size(arr))
        least, most = df.agg(F.min(n), F.max(n)).first()
        if least is None:
            raise ValueError(f"cannot infer the length of empty array column {col!r}")
        if least != most:
            raise ValueError(f"column {col!r} holds arrays of {least} to {most} values; give dim")
        dim = int(least)
    return arr, dim


def _is_ml_vector(dt) -> bool:
    try:
        from pyspark.ml.linalg import VectorUDT
    except ImportError:  # pragma: no cover - ML not installed
        return False
    return isinstance(dt, VectorUDT)


def check_valid(xs: Sequence[Column], invalid: str = "error") -> tuple[list[Column], Column | None]:
    """NULL / NaN policy applied before any assignment.

    ``error``: the job fails on the first bad value (JVM-side raise_error).
    ``skip``: returns a predicate that keeps only complete rows.
    ``keep``: no check (caller guarantees clean data).
    """
    if invalid == "keep":
        return list(xs), None
    bad = [x.isNull() | F.isnan(x) for x in xs]
    if invalid == "error":
        guarded = [
            F.when(b, F.raise_error(F.lit("NULL or NaN feature value; use invalid='skip' to drop such rows")))
            .otherwise(x)
            for x, b in zip(xs, bad)
        ]
        return guarded, None
    if invalid == "skip":
        ok = ~reduce(lambda a, b: a | b, bad)
        return list(xs), ok
    raise ValueError(f"invalid must be 'error', 'skip' or 'keep', not {invalid!r}")


def valid_array(arr: Column, dim: int, invalid: str = "error") -> tuple[Column, Column | None]:
    """The policy of :func:`check_valid` for a whole array of ``dim`` doubles, as one expression."""
    arr = arr.cast("array<double>")
    if invalid == "keep":
        return arr, None
    ok = F.coalesce((F.size(arr) == dim) & F.forall(arr, lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))
    if invalid == "error":
        message = F.lit("NULL or NaN feature value; use invalid='skip' to drop such rows")
        return F.when(ok, arr).otherwise(F.raise_error(message).cast("array<double>")), None
    if invalid == "skip":
        return arr, ok
    raise ValueError(f"invalid must be 'error', 'skip' or 'keep', not {invalid!r}")


def sq_distance(xs: Sequence[Column], centre: Sequence[ColOrNum]) -> Column:
    """Squared Euclidean distance ``sum_j (x_j - c_j) * (x_j - c_j)``."""
    if len(xs) != len(centre):
        raise ValueError(f"dimension mismatch: {len(xs)} features, centre of {len(centre)}")
    terms = []
    for x, c in zip(xs, centre):
        diff = x - _c(c)
        terms.append(diff * diff)
    return _sum(terms)


def dot(a: Sequence[ColOrNum], b: Sequence[ColOrNum]) -> Column:
    if len(a) != len(b):
        raise ValueError("dot of vectors of different length")
    return _sum([_c(x) * _c(y) for x, y in zip(a, b)])


def squared_loss_gradient(y: ColOrNum, phi: Sequence[ColOrNum], w: Sequence[ColOrNum]) -> list[Column]:
    """Per-row gradient of ``(w.phi - y)^2``: ``phi_j * (2 * (w.phi - y))``."""
    r = F.lit(2.0) * (dot(w, phi) - _c(y))
    return [_c(p) * r for p in phi]


def _same_length(a: Column, b: Column, value: Column) -> Column:
    """``value``, or a job error when the two arrays differ in length (M5:
    no silent truncation or NULL padding)."""
    return F.when(F.size(a) != F.size(b),
                  F.raise_error(F.lit("array arguments differ in length"))).otherwise(value)


def array_add(a: Column, b: Column) -> Column:
    """Element-wise sum of two array columns of equal length."""
    return _same_length(a, b, F.zip_with(a, b, lambda x, y: x + y))


def array_subtract(a: Column, b: Column) -> Column:
    """Element-wise difference of two array columns of equal length."""
    return _same_length(a, b, F.zip_with(a, b, lambda x, y: x - y))


def array_scale(s: ColOrNum, a: Column) -> Column:
    """Every element of an array column times ``s``."""
    return F.transform(a, lambda x: x * _c(s))


def array_dot(a: Column, b: Column) -> Column:
    """Dot product of two array columns of equal length."""
    return _same_length(a, b, F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0),
                                          lambda acc, v: acc + v))


def nearest(xs: Sequence[Column], centres: Sequence[Sequence[Number]]) -> tuple[Column, Column]:
    """``(cluster, d2)`` of the nearest centre; ties go to the lowest index.

    ``d2 = least(d2_0 .. d2_{K-1})`` and the index is the first ``i`` with
    ``d2_i = d2``. All-numeric, so it stays in whole-stage codegen (no
    per-row struct), and common distance terms are evaluated once by
    subexpression elimination. NULL / NaN inputs must be handled before
    (see :func:`check_valid`).
    """
    if not centres:
        raise ValueError("no centres")
    ds = [sq_distance(xs, c) for c in centres]
    if len(ds) == 1:
        return F.lit(0), ds[0]
    m = F.least(*ds)
    idx = F.lit(len(ds) - 1)
    for i in range(len(ds) - 2, -1, -1):
        idx = F.when(ds[i] == m, F.lit(i)).otherwise(idx)
    return idx, m


def nearest_centre(xs: Sequence[Column], centres: Sequence[Sequence[Number]]) -> Column:
    """``struct(d2, cluster)`` of the nearest centre (see :func:`nearest`)."""
    idx, m = nearest(xs, centres)
    return F.struct(m.alias("d2"), idx.alias("cluster"))
