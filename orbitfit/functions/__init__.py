"""Column builders: vector arithmetic, nearest centre, seeded uniforms."""

from orbitfit.functions.vector import (
    sq_distance,
    dot,
    squared_loss_gradient,
    nearest_centre,
    feature_columns,
    check_valid,
)
from orbitfit.functions.random import hash_uniform, hash_uniform_sql

__all__ = [
    "sq_distance",
    "dot",
    "squared_loss_gradient",
    "nearest_centre",
    "feature_columns",
    "check_valid",
    "hash_uniform",
    "hash_uniform_sql",
]
