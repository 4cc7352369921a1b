"""Seeded, partition-independent uniforms keyed by row identity.

``hash_uniform(keys, seed)`` is a function of the key values only, so a
sample or a weighted draw does not depend on partitioning, task retries or
the engine: the same formula in SQL gives the same numbers.

Fixed formula (shared with the SQL oracle): take the md5 hex digest of the
key values and the seed joined by ``':'`` (NULL as ``\\n``, a backslash in a
value as two, a colon as ``\\c``, so different keys never join alike), read its first 13 hex digits as
an integer N, and return ``(N + 0.5) / 2^52``, a value strictly inside (0, 1).
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_52 = float(2 ** 52)


def hash_uniform(keys: Sequence[str | Column], *salt: int | str | Column) -> Column:
    return text_uniform(key_text(keys, *salt))


def key_text(keys: Sequence[str | Column], *salt: int | str | Column, numbers: Collection[str] = ()) -> Column:
    """The text that is hashed; more salt may follow after a colon. ``numbers``: names of keys of number types, whose text has neither a backslash nor a colon to replace."""
    parts = []
    for k in keys:
        p = (F.col(k) if isinstance(k, str) else k).cast("string")
        if not (isinstance(k, str) and k in numbers):
            p = F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\c"))
        parts.append(F.coalesce(p, F.lit("\\n")))
    parts += [s.cast("string") if isinstance(s, Column) else F.lit(str(s)) for s in salt]
    return F.concat_ws(":", *parts)


def text_uniform(text: Column) -> Column:
    n = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (n.cast("double") + F.lit(0.5)) / F.lit(TWO_52)


def hash_uniform_sql(keys: Sequence[str], *salt: int | str) -> str:
    """The same uniform as a DuckDB SQL expression."""
    parts = [rf"coalesce(replace(replace(CAST({k} AS VARCHAR), '\', '\\'), ':', '\c'), '\n')" for k in keys] + [f"'{s}'" for s in salt]
    return (
        "((('0x' || substr(md5(concat_ws(':', " + ", ".join(parts) + ")), 1, 13))::BIGINT)"
        "::DOUBLE + 0.5) / 4503599627370496.0"
    )
