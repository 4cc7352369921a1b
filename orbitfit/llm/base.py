"""Helpers that the operators share: tables, work tables, text slices, folds."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitfit.session import own_path, release, shared_dir

# White space of every contract: space, tab, line feed, vertical tab, form
# feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"

__all__ = ["SPACE", "bounded_sample", "drawn", "fold", "fresh", "release", "slices", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage with replicated storage that every executor sees, so a
    lost executor repeats at most the tasks that follow, and an intermediate
    used twice is computed once. The scope that is open, ``release`` or the end
    of the driver removes the tables.
    """
    spark = df.sparkSession
    folder = own_path(spark, f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}")
    df.write.parquet(f"{folder}/{name}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, so that a helper column replaces none."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(key: Column, parts: int) -> Column:
    """Fold number of a row: crc32 of the key as text, modulo ``parts`` (null key: 0)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def drawn(key: Column, bound: int, rows: int) -> Column:
    """Whether a row is of the share ``bound / rows``, by a 64-bit hash of ``key``: the same on every run."""
    if rows <= bound:
        return F.lit(True)
    return F.xxhash64(key.cast("string"), F.lit("fit")) < F.lit(bound * 2**64 // rows - 2**63)


def bounded_sample(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """About ``bound`` rows, chosen by a hash of ``key``: the same rows on every run.

    For model fitting only. A table of up to ``bound`` rows is used whole;
    larger ones keep the share ``bound / rows``, and never nothing.
    """
    rows = df.count()
    found = df.filter(drawn(key, bound, rows))
    if rows > bound and found.isEmpty():   # shared or null keys, or a very small bound
        found = df.orderBy(F.xxhash64(key.cast("string"), F.lit("fit"))).limit(bound)
    return found


def slices(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` characters each (one longer text stands alone)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
