"""Parquet tables and the standard projections used by the queries.

Each helper selects only the columns it needs, so the parquet scan prunes
the rest (``ReadSchema`` in ``explain`` lists just those columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Row identity of a lineitem point: unique at sf0.01 and sf0.1.
LINEITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# With the price in cents and the quantity, rows that are still equal are interchangeable in a fit.
LINEITEM_ORDER = [*LINEITEM_KEYS, "cents", "units"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-D points ``x = l_quantity``, ``y = l_discount * 100`` with their keys."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINEITEM_KEYS, F.col("l_quantity").alias("x"),
                     (F.col("l_discount") * F.lit(100.0)).alias("y"))


def part_regression(spark: SparkSession, sf_dir: str, shard_size: int = 100) -> DataFrame:
    """Linear data from ``part``: ``y = p_retailprice``, ``phi = (x, 1)``.

    ``x = (p_partkey % 1000) / 10`` so that ``y = 900 + x`` exactly; ``seq``
    is the part key and ``shard = floor(seq / shard_size)`` cuts the rows into
    contiguous shards of at most ``shard_size`` rows.
    """
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("seq"),
        F.floor(F.col("p_partkey") / F.lit(shard_size)).cast("long").alias("shard"),
        F.col("p_retailprice").cast("double").alias("y"),
        ((F.col("p_partkey") % 1000) / F.lit(10.0)).alias("x"),
        F.lit(1.0).alias("bias"),
    )


def lineitem_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear data from ``lineitem``: ``y`` the price in thousands, ``phi = (x, 1)`` with ``x`` the
    quantity in tens. Three shards, one per return flag, each about a third of the rows."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *LINEITEM_KEYS,
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("bigint").alias("units"),
        F.ascii("l_returnflag").cast("long").alias("shard"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("y"),
        (F.col("l_quantity") / F.lit(10.0)).alias("x"),
        F.lit(1.0).alias("bias"),
    )


def line_dataset(spark: SparkSession, n: int = 1000, shards: int = 10) -> DataFrame:
    """The generated line (S4): ``x = 2 i + 1``, ``y = x + 2``, ``phi = (x, 1)``.

    ``seq = i`` and ``shard = floor(i * shards / n)`` reproduce ``shards``
    contiguous slices of equal size. Small fixture for tests and goldens.
    """
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.expr(f"id * {int(shards)} div {int(n)}").alias("shard"),
        (F.col("id") * 2 + 3).cast("double").alias("y"),
        (F.col("id") * 2 + 1).cast("double").alias("x"),
        F.lit(1.0).alias("bias"),
    )
