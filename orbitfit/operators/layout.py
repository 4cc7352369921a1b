"""Ordered layouts without range sampling.

Rows are dealt into partitions that follow the order ``(shard, order..., _tie)``:
partition i holds a contiguous slice of it, sorted inside. The cuts come from
counts, not from a sample:

1. the range of the first key is cut into equal slices and the rows of each are
   counted (one aggregate, a bounded number of rows to the driver);
2. a slice that holds more than a quarter of a partition is cut again, between
   the smallest and largest value it really holds, on the first key that still
   varies in it (so a hot shard is cut by its order values, and rows equal on
   those by their row id). Only the rows of such slices are counted again, and
   it goes on until none is left. There are at most a few slices per partition;
3. neighbouring slices are joined up to the size of a partition.

Every row then finds its slice by arithmetic and broadcast tables of the cut
slices, and ``repartitionById`` deals it to its partition. Whatever the cuts,
the layout is ordered; the counts only make it even, so cuts taken from one
permutation of the rows serve other permutations as well.

Keys must be numbers, booleans, dates or timestamps; other types fall back to
Spark's range partitioning. NULL comes first and NaN last, as in Spark's sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Slices of the first key, at least; heavy slices get SLICES_PER_PARTITION for each partition they fill.
FIRST_SLICES = 1024
SLICES_PER_PARTITION = 8
# Rounds of cuts, at most; heavy slices that are left make uneven partitions, not a wrong order.
MAX_ROUNDS = 64
# Beyond every finite key after scaling; NULL and NaN are placed here.
END = 1e300


def as_number(df: DataFrame, name: str) -> str | None:
    """SQL of the column as a double of the same order (NULL first, NaN last); None for other types."""
    kind, c = df.schema[name].dataType, f"`{name}`"
    if isinstance(kind, T.DateType):
        c = f"cast(unix_date({c}) AS double)"
    elif isinstance(kind, T.TimestampNTZType):
        c = f"cast(unix_micros(cast({c} AS timestamp)) AS double)"
    elif isinstance(kind, (T.NumericType, T.BooleanType, T.TimestampType)):
        c = f"cast({c} AS double)"
    else:
        return None
    return f"coalesce(if(isnan({c}), {END!r}D, least(greatest({c}, {-END!r}D), {END!r}D)), {-END!r}D)"


def slice_of(key: str, low: str, high: str, fan: str) -> str:
    """SQL: which of ``fan`` equal slices of [low, high] a key lies in; keys outside go to the end slices."""
    width = f"({high} / 2 - {low} / 2)"
    return (f"cast(if({width} <= 0, 0, least(greatest(floor(({key} / 2 - {low} / 2) / {width} * {fan}), 0), "
            f"{fan} - 1)) AS bigint)")


class Cut(NamedTuple):
    """A slice that is cut again: its number, the key and range it is cut on, the number of
    slices, the number of the first one, and the partitions of the slices (filled in at the end)."""
    cell: int
    key: int
    low: float
    high: float
    fan: int
    base: int
    homes: list[int]


class Cuts:
    """Where the order is cut: one list of ``Cut`` per round, the first one of the whole range."""

    def __init__(self, keys: Sequence[str]):
        self.keys, self.partitions = list(keys), 1
        # SQL that never falls along the order and differs for most rows: sorted by first, it settles most
        # comparisons by Spark's eight-byte prefix, where a key with few values would need the whole rows.
        self.lead: str | None = None
        self.levels: list[list[Cut]] = []

    def placed(self, df: DataFrame) -> DataFrame:
        """Adds ``_cell``, the slice that a row ends in, and ``_part``, its partition.

        The first round is arithmetic; the tables of the others hold a few rows per partition.
        """
        numbers = [as_number(df, k) for k in self.keys]
        (top,), *rest = self.levels
        at = slice_of(numbers[0], f"{top.low!r}D", f"{top.high!r}D", str(top.fan))
        # one literal: a list of literals is slow to plan
        part = f"cast(split('{','.join(map(str, top.homes))}', ',') AS array<int>)[int({at})]" if top.homes else "0"
        df = df.selectExpr("*", f"{at} + {top.base} AS _cell", f"{part} AS _part")
        for cuts in rest:
            table = df.sparkSession.createDataFrame(
                cuts, "_cell long, _k int, _low double, _high double, _fan long, _base long, _homes array<int>")
            key = "CASE _k " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(numbers)) + " END"
            at = slice_of(key, "_low", "_high", "_fan")
            part = f"coalesce(_homes[int({at})], _part)" if cuts[0].homes else "_part"
            kept = [f"`{c}`" for c in df.columns if c not in ("_cell", "_part")]
            df = df.join(F.broadcast(table), "_cell", "left").selectExpr(
                *kept, f"coalesce(_base + {at}, _cell) AS _cell", f"{part} AS _part")
        return df

    def deal(self, df: DataFrame) -> DataFrame:
        """The rows in their partitions, sorted inside."""
        order = [*([F.expr(self.lead)] if self.lead else []), *(F.col(f"`{k}`") for k in self.keys)]
        if not self.levels:
            return df.repartition(1).sortWithinPartitions(*order)
        return (self.placed(df).repartitionById(self.partitions, F.col("_part")).sortWithinPartitions(*order)
                .drop("_cell", "_part"))


def ordered_cuts(df: DataFrame, keys: list[str], rows: int, partitions: int, whole: str | None = None) -> Cuts:
    """Cuts of ``df`` on ``keys`` into about ``partitions`` even partitions.

    ``whole``: a key whose values are not cut apart (each stays in one partition).
    """
    cuts = Cuts(keys)
    if partitions <= 1:
        return cuts
    numbers = [as_number(df, k) for k in keys]
    target = max(1, math.ceil(rows / partitions))
    heavy = target / 4
    spans = [F.expr(f"min({c}) AS a{i}") for i, c in enumerate(numbers)]
    spans += [F.expr(f"max({c}) AS b{i}") for i, c in enumerate(numbers)]
    # Values apart may share a number (past 2^53, at the ends); then the next key must not cut them.
    spans += [F.expr(f"count(`{k}`) = 0 OR (count(`{k}`) = count(1) AND min(`{k}`) = max(`{k}`)) AS one{i}")
              for i, k in enumerate(keys)]
    fan = max(FIRST_SLICES, SLICES_PER_PARTITION * partitions)
    first = df.agg(spans[0], spans[len(keys)]).first()
    if first["a0"] is None:
        return cuts
    cuts.levels.append([Cut(0, 0, first["a0"], first["b0"], fan, 1, [])])
    counts: dict[int, int] = {}
    low, base = 1, 1 + fan              # slices not counted yet, the next free number
    for _ in range(MAX_ROUNDS):
        found = (cuts.placed(df).filter(F.col("_cell") >= low).groupBy("_cell")
                 .agg(F.count(F.lit(1)).alias("n"), *spans).collect())
        counts |= {r["_cell"]: r["n"] for r in found}
        low, cut = base, []
        for r in sorted(found, key=lambda r: r["_cell"]):
            k = next((i for i in range(len(keys)) if not r[f"one{i}"]), None)
            if r["n"] <= heavy or k is None or r[f"a{k}"] >= r[f"b{k}"] or (whole and k > keys.index(whole)):
                continue
            fan = SLICES_PER_PARTITION * (math.ceil(r["n"] / target) + 1)
            cut.append(Cut(r["_cell"], k, r[f"a{k}"], r[f"b{k}"], fan, base, []))
            base += fan
        if not cut:
            break
        cuts.levels.append(cut)
    _join(cuts, counts, target)
    return cuts


def _join(cuts: Cuts, counts: dict[int, int], target: int) -> None:
    """Neighbouring slices share a partition up to its size; a slice that is cut again takes its first one's."""
    by_cell = {c.cell: c for level in cuts.levels for c in level}
    part, filled = 0, 0
    stack = [(by_cell[0], iter(range(by_cell[0].fan)))]
    while stack:
        cut, slices = stack[-1]
        i = next(slices, None)
        if i is None:
            stack.pop()
            continue
        cell = cut.base + i
        if cell in by_cell:
            cut.homes.append(part)
            stack.append((by_cell[cell], iter(range(by_cell[cell].fan))))
            continue
        n = counts.get(cell, 0)
        if filled and filled + n > target:
            part, filled = part + 1, 0
        filled += n
        cut.homes.append(part)
    cuts.partitions = part + 1


def sorted_layout(df: DataFrame, shard: str, order: Sequence[str], y: str, phi: Sequence[str],
                  rows: int, partitions: int, tie: str | None = None, keep: Sequence[str] = (),
                  whole_shards: bool = False) -> DataFrame:
    """Rows in about ``partitions`` partitions that follow ``(shard, order..., _tie)``, sorted inside.

    Output columns ``shard, y, p0..p{d-1}`` (and ``keep``) in that order. A large shard
    spans several partitions unless ``whole_shards``. ``order`` should identify
    rows within a shard; rows equal on it keep their input order through
    ``_tie`` (the column ``tie``, or a position id taken here, reproducible
    when the rows come straight from a file scan), which also cuts a large
    group of such rows. ``rows``: the row count. A NULL shard is an error.
    """
    names = [shard, *order]
    keyed = df.withColumn("_tie", F.col(tie) if tie else F.monotonically_increasing_id())
    keys = [*dict.fromkeys(names), "_tie"]
    wanted = list(dict.fromkeys([*keys, y, *phi, *keep]))
    keyed = keyed.select(*[F.col(f"`{c}`") for c in wanted])
    if all(as_number(keyed, k) is not None for k in keys):
        dealt = ordered_cuts(keyed, keys, rows, partitions, shard if whole_shards else None).deal(keyed)
    else:
        cols = [F.col(f"`{k}`") for k in keys]
        dealt = keyed.repartitionByRange(partitions, *cols[:1 if whole_shards else None]).sortWithinPartitions(*cols)
    return as_layout(dealt, shard, y, phi, keep)


def as_layout(dealt: DataFrame, shard: str, y: str, phi: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    no_shard = F.raise_error(F.lit("NULL shard")).cast("long")
    return dealt.select(F.coalesce(F.col(f"`{shard}`").cast("long"), no_shard).alias("shard"),
                        F.col(f"`{y}`").cast("double").alias("y"),
                        *[F.col(f"`{p}`").cast("double").alias(f"p{j}") for j, p in enumerate(phi)],
                        *[F.col(f"`{c}`").alias(f"k{j}") for j, c in enumerate(keep)])
