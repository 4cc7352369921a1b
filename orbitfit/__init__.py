"""orbitfit: k-means clustering and gradient-method linear models as Spark jobs.

Everything is expressed with DataFrame operations: points, centres, histories
and reports are DataFrames or bounded driver-side lists (K centres, d weights).
Iterative fits run one distributed aggregate per iteration over a persisted,
column-pruned projection of the input.
"""

from orbitfit.session import Scope, get_session, release, shared_dir
from orbitfit.functions.vector import sq_distance, dot, nearest_centre
from orbitfit.functions.random import hash_uniform
from orbitfit.operators.kmeans import kmeans_fit, KMeansModel
from orbitfit.operators.seeding import kmeanspp_init, random_init
from orbitfit.operators.sampling import sample_by_hash
from orbitfit.operators.linear import (
    column_moments,
    standardize,
    normal_stats,
    mse,
    gradient,
    full_batch_history,
)
from orbitfit.operators.momentum import (
    heavy_ball,
    nesterov,
    local_sgd,
)

__all__ = [
    "get_session",
    "shared_dir",
    "Scope",
    "release",
    "sq_distance",
    "dot",
    "nearest_centre",
    "hash_uniform",
    "kmeans_fit",
    "KMeansModel",
    "kmeanspp_init",
    "random_init",
    "sample_by_hash",
    "column_moments",
    "standardize",
    "normal_stats",
    "mse",
    "gradient",
    "full_batch_history",
    "heavy_ball",
    "nesterov",
    "local_sgd",
]
