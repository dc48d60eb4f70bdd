"""Seeding: hash sample (X1), weighted draw (W1, F3), K-Means++.

The reference draws a centre by walking a running sum of weights until it passes a random target.
That needs one ordered pass over all rows in one task. Here a draw is the row with the least
exponential key ``-ln(u)/w`` (probability proportional to ``w``), found by ``orderBy(key).limit(1)``:
Spark plans it as ``TakeOrderedAndProject`` (a top-1 per partition, then a merge of one row per
partition), so a draw is one pass with no shuffle of the data and no single-task bottleneck. The literal
walk exists too, as a distributed running sum (``operators.prefix``).

K-Means++ over all points takes a pass per centre. ``kmeans_parallel`` (Bahmani et al., 2012) takes a fixed number of
rounds whatever K is, each drawing about ``2 K`` candidates at once, and reclusters the weighted candidates.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centroidal.functions.geometry import Centre, exact_sum
from centroidal.functions.hashing import exponential_key, exponential_value, hash_uniform
from centroidal.operators.assign import nearest_struct

X, Y = "pickup_longitude", "pickup_latitude"

# The reference seeds every draw with 42 and samples about 10,000 points.
DEFAULT_SEED = 42
DEFAULT_SAMPLE_TARGET = 10_000
#: Rounds of ``kmeans_parallel``, candidates of a round over K, and decimals of the summed cost.
ROUNDS, OVERSAMPLING, COST_SCALE = 5, 2.0, 9


def sample_fraction(n_rows: int, target: int) -> float:
    """``min(1, target / n)``; the reference's fraction for a sample of about ``target`` rows."""
    if n_rows <= 0:
        raise ValueError("cannot sample an empty input")
    return min(1.0, target / n_rows)


def hash_sample(df: DataFrame, target: int = DEFAULT_SAMPLE_TARGET, key: str = "id",
                seed: int = DEFAULT_SEED, n_rows: int | None = None) -> DataFrame:
    """Bernoulli sample of about ``target`` rows, keyed on ``key``.

    Unlike ``df.sample`` the result does not depend on the partitioning. When ``n_rows`` is not given
    the row count is a scalar subquery evaluated by Spark, not a driver loop.
    """
    if n_rows is None:
        total = df.select(F.count(F.lit(1)).cast("double")).scalar()
        fraction: Column = F.least(F.lit(1.0), F.lit(float(target)) / total)
    else:
        fraction = F.lit(sample_fraction(n_rows, target))
    return df.filter(hash_uniform(key, seed, "sample") < fraction)


def weighted_draw(df: DataFrame, weight, key: str = "id", seed: int = DEFAULT_SEED,
                  stream: str = "draw") -> DataFrame:
    """One row drawn with probability proportional to ``weight`` (W1, F3); rows with weight <= 0 never.

    Returns at most one row with an extra ``draw_key`` column; no row when every weight is 0. Rows without a key go
    last and are dropped after the limit: a filter before it would be pushed below the weight, and a weight from a Python
    UDF would be computed twice, by two Python workers a task.
    """
    keyed = df.withColumn("draw_key", exponential_key(key, weight, seed, stream))
    return keyed.orderBy(F.col("draw_key").asc_nulls_last(), key).limit(1).filter(F.col("draw_key").isNotNull())


def kmeanspp_round_weight(centres: Sequence[Centre], x=X, y=Y, multiplicity=None) -> Column:
    """Weight of a point in the next K-Means++ round: (multiplicity x) least squared distance."""
    # The vectorised scan: an expression over r centres would be compiled anew, and longer, every round.
    w = F.lit(1.0) if not centres else nearest_struct(centres, x, y)["sq_dist"]
    if multiplicity is not None:
        w = w * (F.col(multiplicity) if isinstance(multiplicity, str) else multiplicity)
    return w


def kmeanspp(df: DataFrame, k: int, x: str = X, y: str = Y, key: str = "id",
             seed: int = DEFAULT_SEED, multiplicity: str | None = None) -> list[Centre]:
    """K-Means++ seeds (X3; X2 when ``df`` is a sample).

    Round 0 draws uniformly (by multiplicity); round r draws with probability proportional to the
    least squared distance to the r centres chosen so far. Each round is one ``TakeOrderedAndProject``
    job returning one row. Points already chosen have weight 0 and are never drawn again, so when
    there are fewer than K distinct points a ``ValueError`` says so (V12). Cost: K passes over ``df``,
    so pass a persisted or sampled frame.
    """
    if k < 1:
        raise ValueError("K must be at least 1")
    base = df.select(key, x, y, *( [multiplicity] if multiplicity else []))
    centres: list[Centre] = []
    for r in range(k):
        w = kmeanspp_round_weight(centres, x, y, multiplicity)
        row = weighted_draw(base.withColumn("_w", w), "_w", key, seed, f"kmeanspp:{r}").select(x, y).first()
        if row is None:
            if r == 0:
                raise ValueError("no points to seed from")
            raise ValueError(f"only {r} distinct points; cannot choose K={k} distinct centres")
        centres.append((float(row[0]), float(row[1])))
    return centres


def recluster(candidates: Sequence[tuple], weights: Sequence[float], k: int, seed: int) -> list[Centre]:
    """Weighted K-Means++ over a few thousand candidates ``(key, x, y)`` on the driver, with the draws of ``kmeanspp``.
    A candidate that is drawn, or has weight 0, is not drawn again."""
    x, y = (np.array([c[i] for c in candidates], float) for i in (1, 2))
    keys, w = [str(c[0]) for c in candidates], np.array(weights, float)
    cost, chosen = w, []
    for r in range(k):
        keyed = [(exponential_value(keys[i], cost[i], seed, f"kmeanspp:{r}"), candidates[i][0], i) for i in np.flatnonzero(cost > 0).tolist()]
        if not keyed:
            raise ValueError(f"only {r} distinct points; cannot choose K={k} distinct centres")
        _, _, at = min(keyed)
        chosen.append((float(x[at]), float(y[at])))
        dx, dy = x - x[at], y - y[at]
        d = dx * dx + dy * dy
        least = d if r == 0 else np.minimum(least, d)
        cost = least * w
    return chosen


def kmeans_parallel(df: DataFrame, k: int, x: str = X, y: str = Y, key: str = "id", seed: int = DEFAULT_SEED,
                    multiplicity: str | None = None, rounds: int = ROUNDS, oversampling: float = OVERSAMPLING) -> list[Centre]:
    """K-Means‖ seeds (X3 for large K): two passes a round, whatever K is.

    Round 0 draws one point uniformly. Each further round takes every point independently with probability
    ``min(1, oversampling * K * cost / total cost)``, its cost being (multiplicity x) the least squared distance to the
    candidates so far. Candidates, in the order of their round and key, are weighted by the points nearest to them and
    reduced to K by weighted K-Means++. The driver holds about ``rounds * oversampling * K`` candidates. More rounds
    follow while there are fewer than K; fewer distinct points than K raise ``ValueError`` (V12).
    """
    if k < 1:
        raise ValueError("K must be at least 1")
    base = df.select(key, x, y, *([multiplicity] if multiplicity else []))
    first = weighted_draw(base.withColumn("_w", kmeanspp_round_weight([], x, y, multiplicity)), "_w", key, seed, "parallel:0").select(key, x, y).first()
    if first is None:
        raise ValueError("no points to seed from")
    candidates, r = [tuple(first)], 0
    while r < rounds or len(candidates) < k:
        r += 1
        costed = base.withColumn("_w", kmeanspp_round_weight([c[1:] for c in candidates], x, y, multiplicity))
        total = float(costed.agg(exact_sum("_w", COST_SCALE).alias("t")).first()["t"] or 0) / float(10 ** COST_SCALE)
        if total <= 0:
            break
        share = F.lit(oversampling * k) * F.col("_w") / F.lit(total)
        picked = costed.filter(hash_uniform(key, seed, f"parallel:{r}") < share).select(key, x, y).collect()
        candidates += sorted(tuple(p) for p in picked)
    near = base.withColumn("_c", nearest_struct([c[1:] for c in candidates], x, y)["cluster_id"])
    weights = [0.0] * len(candidates)
    counted = F.sum(F.col(multiplicity).cast("double")) if multiplicity else F.count(F.lit(1)).cast("double")
    for row in near.filter(F.col("_c").isNotNull()).groupBy("_c").agg(counted.alias("m")).collect():
        weights[row["_c"]] = row["m"]
    return recluster(candidates, weights, k, seed)


def seeds_frame(spark, centres: Sequence[Centre]) -> DataFrame:
    """K seeds as ``(cluster_id int, cx double, cy double)``; K rows built on the driver."""
    rows = [(i, float(cx), float(cy)) for i, (cx, cy) in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster_id int, cx double, cy double")
