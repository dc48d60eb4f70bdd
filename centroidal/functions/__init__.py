"""Column expressions (all built from ``pyspark.sql.functions``)."""

from centroidal.functions.geometry import (
    sq_dist, centre_distances, min_sq_dist, nearest_centre, micro_units, exact_sum, exact_mean, exact_total,
    mean_from_exact,
)
from centroidal.functions.hashing import hash_uniform, hash_uniform_sql, exponential_key

__all__ = [
    "sq_dist", "centre_distances", "min_sq_dist", "nearest_centre", "micro_units", "exact_sum",
    "exact_mean", "exact_total", "mean_from_exact", "hash_uniform", "hash_uniform_sql", "exponential_key",
]
