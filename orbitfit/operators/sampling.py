"""Exact-size seeded samples without replacement.

A sample of n rows is the n smallest ``hash_uniform(keys, seed)`` values,
ties broken on the key and the tie columns. ``orderBy(...).limit(n)`` plans
as ``TakeOrderedAndProject``: every task keeps its own n best rows and only
those reach the final merge, so the cost is one scan and n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.functions.random import hash_uniform


def sample_by_hash(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42,
                   tie_cols: Sequence[str] = (), u_col: str = "u") -> DataFrame:
    """The n rows with the smallest seeded uniform; adds column ``u_col``."""
    if n <= 0:
        raise ValueError("sample size must be positive")
    order = [F.col(u_col)] + [F.col(k) for k in keys] + [F.col(c) for c in tie_cols]
    return df.withColumn(u_col, hash_uniform(keys, seed)).orderBy(*order).limit(n)
