"""Distance expressions (F1, F2) and the JVM-side nearest-centre expression.

All expressions are built from built-in Column arithmetic, so they stay inside whole-stage codegen.
Squared distances are written ``dx*dx + dy*dy`` (no ``pow``, no square root) so that Spark, NumPy and
DuckDB produce the same bits for the same inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Centre = tuple[float, float]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sq_dist(x, y, cx, cy) -> Column:
    """Squared Euclidean distance between (x, y) and (cx, cy); any argument may be a column or a float."""
    dx = _col(x) - (cx if isinstance(cx, Column) else F.lit(float(cx)))
    dy = _col(y) - (cy if isinstance(cy, Column) else F.lit(float(cy)))
    return dx * dx + dy * dy


def centre_distances(x, y, centres: Sequence[Centre]) -> list[Column]:
    """One squared-distance column per centre, in centre order."""
    return [sq_dist(x, y, cx, cy) for cx, cy in centres]


def min_sq_dist(x, y, centres: Sequence[Centre]) -> Column:
    """Least squared distance from (x, y) to any of ``centres`` (F2)."""
    dists = centre_distances(x, y, centres)
    if not dists:
        raise ValueError("min_sq_dist needs at least one centre")
    return dists[0] if len(dists) == 1 else F.least(*dists)


def nearest_centre(x, y, centres: Sequence[Centre]) -> Column:
    """``struct<cluster_id int, sq_dist double>`` of the nearest centre, ties to the lowest id (V4).

    Written as ``m = least(d_0..d_K-1)`` and ``cluster_id = first k with d_k = m``: the same result as a
    sequential scan with strict ``<``, in plain codegen-friendly expressions. Suited to small K; the
    Arrow form in ``operators.assign`` is the fast path for the fit loop.
    """
    dists = centre_distances(x, y, centres)
    if not dists:
        raise ValueError("nearest_centre needs at least one centre")
    m = min_sq_dist(x, y, centres)
    if len(dists) == 1:
        return F.struct(F.lit(0).alias("cluster_id"), m.alias("sq_dist"))
    chain = F.when(dists[0] == m, F.lit(0))
    for k, d in enumerate(dists[1:-1], start=1):
        chain = chain.when(d == m, F.lit(k))
    chain = chain.otherwise(F.lit(len(dists) - 1))
    return F.struct(chain.cast("int").alias("cluster_id"), m.alias("sq_dist"))


def micro_units(c, scale: int = 6) -> Column:
    """Coordinate as an integer count of 10^-scale units: ``floor(c * 10^scale + 0.5)``.

    This fixed, engine-independent rounding (one IEEE multiply, one add, floor) is what makes the
    centre sums exact: the sums of these integers do not depend on partitioning or summation order.
    """
    return F.floor(_col(c) * F.lit(float(10 ** scale)) + F.lit(0.5))


# The unit value is split into a high part (units >> SPLIT_BITS) and a low part (the last SPLIT_BITS
# bits, 0..65535), each summed as bigint: per-row work stays primitive long arithmetic. With
# |coordinate| < 1e3 at 10^-6 units, the sums cannot overflow below about 10^14 rows per group.
SPLIT_BITS = 16


def exact_sum(c, scale: int = 6, weight=None) -> Column:
    """Exact sum of a coordinate in 10^-scale units, as ``decimal(38,0)``.

    Aggregate expression: two ``bigint`` sums per row (high and low part of the unit value, times the
    weight if given), recombined as ``high * 2^16 + low`` on the aggregated row only.
    """
    units = micro_units(c, scale)
    hi = F.shiftright(units, SPLIT_BITS)
    lo = units.bitwiseAND(F.lit((1 << SPLIT_BITS) - 1).cast("long"))
    if weight is not None:
        w = _col(weight).cast("long")
        hi, lo = hi * w, lo * w
    return (F.sum(hi).cast("decimal(38,0)") * F.lit(1 << SPLIT_BITS).cast("decimal(38,0)")
            + F.sum(lo).cast("decimal(38,0)")).cast("decimal(38,0)")


def exact_mean(c, scale: int = 6) -> Column:
    """Mean of a column from its exact 10^-scale unit sum (aggregate): partition- and engine-independent."""
    return mean_from_exact(exact_sum(c, scale), F.count(_col(c)), scale)


def exact_total(c, scale: int = 6) -> Column:
    """Sum of a column at 10^-scale resolution, exactly (aggregate), as a double."""
    return exact_sum(c, scale).cast("double") / F.lit(float(10 ** scale))


def mean_from_exact(sum_units: Column, count: Column, scale: int = 6) -> Column:
    """Mean coordinate from an exact unit sum: ``double(sum) / double(n) / 10^scale``."""
    return sum_units.cast("double") / count.cast("double") / F.lit(float(10 ** scale))
