"""Assign a stream of points to fitted centres (K10 on a stream)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from orbitfit.operators.kmeans import KMeansModel
from orbitfit.operators.points import Features


def assign_stream(stream: DataFrame, model: KMeansModel, features: Features | None = None,
                  keys: Sequence[str] = (), invalid: str = "skip") -> DataFrame:
    """Streaming DataFrame of ``keys, features, cluster, d2``.

    Centres are literals in the plan, so every micro-batch is one narrow,
    codegen'd projection with no state and no shuffle. ``invalid`` defaults
    to ``skip``: one bad record should not stop a long-running query.
    """
    if not stream.isStreaming:
        raise ValueError("assign_stream expects a streaming DataFrame; use model.assign for batch")
    return model.assign(stream, features, keys, invalid)
