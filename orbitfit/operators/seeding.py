"""Starting centres: seeded uniform sample (L1) and distance-squared seeding (K3).

Distance-squared seeding (k-means++, Arthur & Vassilvitskii 2007) needs, for
each new centre, one draw with probability proportional to the squared
distance to the nearest chosen centre. Instead of a running total over all
points on the driver, each round is a single distributed aggregate: every
row gets the key ``-ln(u) / w`` with ``u`` its seeded uniform for the round
and ``w`` its weight, and the row with the smallest key is an exact weighted
draw (exponential race; Efraimidis & Spirakis 2006). ``min(struct(key, x..))``
is combined per task first, so only one row per task crosses the network.

Rows with weight 0 (points equal to a chosen centre) are excluded, so a
centre is never chosen twice.

For small K each round recomputes the distance to every chosen centre from
the cached points (r terms in round r; cheaper than caching a new copy).
Above ``INCREMENTAL_ABOVE`` centres the squared distance to the nearest
chosen centre is kept as a persisted column ``_md`` and each round adds only
the distance to the newest centre, ``least(_md, d2_new)``; the draw job
materialises the new copy and the previous one is released. Every
``REBUILD_EVERY`` rounds ``_md`` is rebuilt from the points, so plans and
recomputation chains stay short. ``least`` is exact, so both ways draw the
same centres.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.functions.random import hash_uniform
from orbitfit.functions.vector import sq_distance
from orbitfit.operators.blocks import with_min_d2
from orbitfit.operators.sampling import sample_by_hash
from orbitfit.session import dematerialize, materialize

INCREMENTAL_ABOVE = 16
REBUILD_EVERY = 32


def random_init(points: DataFrame, keys: Sequence[str], names: Sequence[str], k: int,
                seed: int = 42) -> list[tuple[float, ...]]:
    """K starting centres: the K points with the smallest seeded uniform."""
    rows = sample_by_hash(points.select(*keys, *names), keys, k, seed, tie_cols=names).collect()
    if len(rows) < k:
        raise ValueError(f"K={k} is larger than the number of points ({len(rows)})")
    return [coordinates(r, names) for r in rows]


def coordinates(row, names: Sequence[str]) -> tuple[float, ...]:
    """A point from its columns, or from its one array column."""
    if len(names) == 1 and isinstance(row[names[0]], (list, tuple)):
        return tuple(float(v) for v in row[names[0]])
    return tuple(float(row[n]) for n in names)


def min_sq_distance(xs, centres) -> "F.Column":
    """Squared distance to the nearest of ``centres``."""
    d = [sq_distance(xs, c) for c in centres]
    return d[0] if len(d) == 1 else F.least(*d)


def weighted_draw(df: DataFrame, weight: "F.Column", keys: Sequence[str], names: Sequence[str],
                  seed: int, salt: int) -> tuple[float, ...] | None:
    """One row drawn with probability proportional to ``weight`` (> 0 only)."""
    u = hash_uniform(keys, seed, salt)
    race = (-F.log(u)) / weight
    best = (
        df.select(race.alias("key"), weight.alias("w"), *[F.col(n) for n in names])
        .where(F.col("w") > 0)
        .agg(F.min(F.struct("key", *names)).alias("best"))
        .collect()[0]["best"]
    )
    if best is None:
        return None
    return coordinates(best, names)


def kmeanspp_init(points: DataFrame, keys: Sequence[str], names: Sequence[str], k: int,
                  seed: int = 42, incremental: bool | None = None,
                cache: str = "persist") -> list[tuple[float, ...]]:
    """K centres by distance-squared seeding, repeatable from ``seed``.

    Round 0 takes the point with the smallest uniform ``hash_uniform(keys,
    seed, 0)``; round r draws with weights ``min_d2`` and uniforms salted
    with r. Each round is one aggregate job returning one row.
    ``incremental``: keep ``min_d2`` as a persisted column (default: when
    ``k > INCREMENTAL_ABOVE``). ``cache``: how the points are kept for the K
    passes, so that the source is read once ("none": they are kept already).
    ``names`` may be one array column, whose distances NumPy blocks compute.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    xs = [F.col(n) for n in names]
    u0 = hash_uniform(keys, seed, 0)
    if incremental is None:
        incremental = k > INCREMENTAL_ABOVE
    cur = None
    pts = materialize(points.select(*keys, *names), cache if k > 1 else "none")
    try:
        first = pts.agg(F.min(F.struct(u0.alias("u"), *xs)).alias("best")).collect()[0]["best"]
        if first is None:
            raise ValueError("no points to seed from")
        centres = [coordinates(first, names)]
        wide = isinstance(pts.schema[names[0]].dataType, T.ArrayType)
        for r in range(1, k):
            if wide:
                nxt = weighted_draw(with_min_d2(pts, names[0], centres, "_md"), F.col("_md"), keys, names, seed, r)
            elif not incremental:
                nxt = weighted_draw(pts, min_sq_distance(xs, centres), keys, names, seed, r)
            else:
                if cur is None or (r - 1) % REBUILD_EVERY == 0:
                    md = min_sq_distance(xs, centres).alias("_md")
                    src = pts
                else:
                    md = F.least(F.col("_md"), sq_distance(xs, centres[-1])).alias("_md")
                    src = cur
                new = materialize(src.select(*keys, *names, md))
                nxt = weighted_draw(new, F.col("_md"), keys, names, seed, r)
                if cur is not None:
                    dematerialize(cur)
                cur = new
            if nxt is None:
                raise ValueError(
                    f"only {len(centres)} distinct points; cannot seed K={k} centres")
            centres.append(nxt)
    finally:
        if cur is not None:
            dematerialize(cur)
        if k > 1:
            dematerialize(pts, cache)
    return centres
