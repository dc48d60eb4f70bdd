"""Lloyd's K-Means: one step (X4, A1, A5, P10), the fit loop (X5, K8), prediction (X6), caching.

One Spark job per iteration. Every point is assigned to the current centres *and* to the previous
ones in the same pass (no cached assignment); per cluster the job computes exact coordinate sums, the
count, the sum of squared distances and the number of points that moved. Each partition
is reduced to at most K partial rows inside its task (``mapInArrow``) and one ``groupBy(cluster_id)``
merges them, so the shuffle carries at most K rows per partition whatever the data size or skew. The
centres go out as K pairs of floats in the next plan, so the plan and the lineage do not grow with
the number of iterations. The fit loop packs its points once into small boxes (``operators.blocks``); a pass then
measures only the points whose box more than one centre can be nearest to.

Exact sums: coordinates are summed as integers of 10^-scale units (``functions.geometry.micro_units``)
- Python integers inside a task, ``decimal(38,0)`` across tasks - so the centres are
bit-identical for any partitioning and in any engine that follows the same rule.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centroidal.functions.geometry import Centre, exact_sum
from centroidal.operators.assign import (
    PARTIALS_SCHEMA, X, Y, assign_nearest, lloyd_partials_fn, nearest_struct, with_nearest_expr,
)
from centroidal.operators.blocks import block_pass, pack_points
from centroidal.operators.seed import (
    DEFAULT_SAMPLE_TARGET, DEFAULT_SEED, hash_sample, kmeans_parallel, kmeanspp, recluster,
    sample_fraction,
)
from centroidal.session import kept


def lloyd_partials(points: DataFrame, centres: Sequence[Centre], prev_centres: Sequence[Centre] | None = None,
                   x: str = X, y: str = Y, weight: str | None = None, scale: int = 6) -> DataFrame:
    """Per-partition partial sums of one Lloyd pass: at most K rows per partition (``mapInArrow``)."""
    cols = [x, y] + ([weight] if weight else [])
    return points.select(*cols).mapInArrow(
        lloyd_partials_fn(centres, prev_centres, x, y, weight, scale), PARTIALS_SCHEMA)


def merged(partials: DataFrame) -> DataFrame:
    """Partial rows of one pass added up by cluster."""
    sums = [c for c in partials.columns if c != "cluster_id"]
    return partials.groupBy("cluster_id").agg(*[F.sum(c).alias(c) for c in sums])


def lloyd_aggregate(points: DataFrame, centres: Sequence[Centre], prev_centres: Sequence[Centre] | None = None,
                    x: str = X, y: str = Y, weight: str | None = None, method: str = "partials",
                    scale: int = 6) -> DataFrame:
    """Per-cluster sums of one Lloyd step, lazily: ``cluster_id, sx, sy, n, sse, moved``.

    ``sx``/``sy`` are exact sums in 10^-scale units (``decimal(38,0)``), ``n`` the (weighted) count,
    ``sse`` the sum of squared distances to the centres used for the assignment, ``moved`` the
    (weighted) number of points whose nearest centre differs between ``prev_centres`` and ``centres``
    (all points when there are no previous centres, V7). Empty clusters have no row; rows with a
    missing coordinate are ignored.

    ``method``: ``"partials"`` (default) - ``mapInArrow`` returns at most K partial rows per partition
    and one ``groupBy`` merges them; ``"arrow"`` - a vectorised UDF tags each row with its cluster and
    Spark's partial/final ``HashAggregate`` sums; ``"expr"`` - the same with built-in expressions.
    All three give identical results; each is one job whose shuffle carries at most K rows per task.
    """
    if method == "partials":
        # At most K partial rows per partition; AQE reads the few merged rows in as few tasks as they need.
        return merged(lloyd_partials(points, centres, prev_centres, x, y, weight, scale))
    if method == "arrow":
        a = (points.withColumn("_a", nearest_struct(centres, x, y, prev_centres))
             .withColumn("_k", F.col("_a.cluster_id")).withColumn("_d", F.col("_a.sq_dist")))
        if prev_centres is not None:
            a = a.withColumn("_kp", F.col("_a.prev_cluster"))
    elif method == "expr":
        a = with_nearest_expr(points, centres, x, y, prefix="_c").withColumnsRenamed(
            {"_ccluster_id": "_k", "_csq_dist": "_d"})
        if prev_centres is not None:
            a = with_nearest_expr(a, prev_centres, x, y, prefix="_p").withColumnRenamed("_pcluster_id", "_kp")
    else:
        raise ValueError(f"unknown method {method!r}; use 'partials', 'arrow' or 'expr'")
    a = a.filter(F.col("_k").isNotNull())
    w = F.col(weight) if weight else F.lit(1)
    if prev_centres is None:
        moved = F.sum(w.cast("long"))
    else:
        moved = F.sum(F.when(F.col("_k") != F.col("_kp"), w.cast("long")).otherwise(F.lit(0)))
    return (a.groupBy(F.col("_k").alias("cluster_id"))
             .agg(exact_sum(x, scale, weight).alias("sx"),
                  exact_sum(y, scale, weight).alias("sy"),
                  F.sum(w.cast("long")).alias("n"),
                  F.sum(F.col("_d") * w).alias("sse"),
                  moved.alias("moved")))


@dataclass
class StepResult:
    centres: list[Centre]
    counts: list[int]
    n_moved: int
    wcss_before: float
    wcss_after: float
    #: Distances computed between a point and a centre, where the form counts them.
    pairs: int | None = None


def apply_update(rows, centres: Sequence[Centre], scale: int = 6) -> StepResult:
    """Turn the K aggregate rows of a step into new centres (driver side, K values).

    Empty clusters keep their centre and id with count 0 (V5, V6). ``wcss_before`` is measured
    against the centres used for the assignment (as the reference Spark job); ``wcss_after`` against
    the new centres, by the identity ``sum |p - c_new|^2 = sse - n |c_old - c_new|^2`` for means.
    """
    k = len(centres)
    unit = float(10 ** scale)
    new = list(centres)
    counts = [0] * k
    moved = 0
    before = 0.0
    after = 0.0
    pairs = sum(r["pairs"] for r in rows) if rows and "pairs" in rows[0] else None
    for r in sorted(rows, key=lambda r: r["cluster_id"]):
        c = int(r["cluster_id"])
        n = int(r["n"])
        sse = float(r["sse"] or 0.0)
        moved += int(r["moved"] or 0)
        before += sse
        if n > 0:
            nx = float(r["sx"]) / float(n) / unit
            ny = float(r["sy"]) / float(n) / unit
            ox, oy = centres[c]
            after += sse - n * ((ox - nx) * (ox - nx) + (oy - ny) * (oy - ny))
            new[c] = (nx, ny)
            counts[c] = n
    return StepResult(new, counts, moved, before, after, pairs)


def lloyd_step(points: DataFrame, centres: Sequence[Centre], prev_centres: Sequence[Centre] | None = None,
               x: str = X, y: str = Y, weight: str | None = None, method: str = "partials",
               scale: int = 6) -> StepResult:
    """Run one Lloyd iteration (one Spark job; K rows come back) and return the updated centres and counters."""
    rows = lloyd_aggregate(points, centres, prev_centres, x, y, weight, method, scale).collect()
    return apply_update(rows, centres, scale)


def packed_step(packed: DataFrame, centres: Sequence[Centre], prev_centres: Sequence[Centre] | None = None, scale: int = 6) -> StepResult:
    """``lloyd_step`` over points packed by ``pack_points``; the same centres, counts and moved points."""
    return apply_update(merged(block_pass(packed, centres, prev_centres, scale)).collect(), centres, scale)


@dataclass
class KMeansModel:
    """Result of a fit: final centres and counts, per-iteration history, timings."""
    centres: list[Centre]
    counts: list[int]
    seeds: list[Centre]
    history: list[dict] = field(default_factory=list)
    n_points: int = 0
    converged: bool = False
    load_time_sec: float = 0.0
    seed_time_sec: float = 0.0
    n_partitions: int = 0
    x: str = X
    y: str = Y

    @property
    def k(self) -> int:
        return len(self.centres)

    @property
    def iterations(self) -> int:
        return len(self.history)

    @property
    def total_time_sec(self) -> float:
        return float(sum(h["iter_time_sec"] for h in self.history))

    @property
    def final_wcss(self):
        return self.history[-1]["wcss"] if self.history else None

    @property
    def throughput_pts_sec(self) -> float:
        """``N * iterations / loop seconds`` as in the reference's run records."""
        return self.n_points * self.iterations / max(self.total_time_sec, 1e-9)

    def centres_frame(self, spark: SparkSession) -> DataFrame:
        """``cluster_id int, cx double, cy double, cnt bigint`` - K rows."""
        rows = [(i, float(cx), float(cy), int(n)) for i, ((cx, cy), n) in enumerate(zip(self.centres, self.counts))]
        return spark.createDataFrame(rows, "cluster_id int, cx double, cy double, cnt bigint")

    def history_frame(self, spark: SparkSession) -> DataFrame:
        """``iteration int, n_moved bigint, wcss double, wcss_after double, iter_time_sec double, pairs bigint``."""
        rows = [(int(h["iteration"]), int(h["n_moved"]), float(h["wcss"]), float(h["wcss_after"]),
                 float(h["iter_time_sec"]), h.get("pairs")) for h in self.history]
        return spark.createDataFrame(
            rows, "iteration int, n_moved bigint, wcss double, wcss_after double, iter_time_sec double, pairs bigint")

    def predict(self, df: DataFrame, out: str = "cluster_id", method: str = "arrow",
                dist_col: str | None = None) -> DataFrame:
        """Assign rows to the final centres (X6); lazy and narrow."""
        return assign_nearest(df, self.centres, self.x, self.y, out=out, dist_col=dist_col, method=method)


def location_key(x: str = X, y: str = Y):
    """Text key of a location, used to sample and seed inputs that have no row key."""
    return F.concat_ws(",", F.col(x).cast("string"), F.col(y).cast("string"))


def choose_seeds(points: DataFrame, k: int, init: str, n_rows: int, x: str, y: str, key: str | None,
                 weight: str | None, seed: int, sample_target: int) -> list[Centre]:
    """Starting centres: ``kmeans++`` over all points (X3), ``kmeans||`` over all points in a fixed number of passes,
    or ``sample``: K-Means++ over a hash sample of about ``sample_target`` rows (X1 + X2), which one job brings to
    the driver; its rounds draw like those over all points.

    Without a row key, duplicate rows cannot be told apart, so whole *locations* are sampled (hash of
    the coordinates, fraction from an approximate distinct count) and folded with their multiplicity;
    each location's draw probability stays proportional to its row count. ``n_rows`` is the number of rows (the
    sampling units), not the weighted total.
    """
    if init not in ("sample", "kmeans++", "kmeans||"):
        raise ValueError(f"unknown init {init!r}; use 'sample', 'kmeans++', 'kmeans||' or pass initial_centres")
    draw = kmeans_parallel if init == "kmeans||" else kmeanspp
    if key is not None:
        if init != "sample":
            return draw(points, k, x, y, key, seed, weight)
        base, mult = points, weight
        if sample_fraction(n_rows, sample_target) < 1.0:
            base = hash_sample(points, sample_target, key, seed, n_rows=n_rows)
    else:
        key, mult = "_key", "_m"
        base = points.withColumn("_key", location_key(x, y))
        if init == "sample":
            n_loc = base.agg(F.approx_count_distinct("_key").alias("n")).first()["n"]
            base = hash_sample(base, sample_target, "_key", seed, n_rows=max(int(n_loc), 1))
        total = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
        base = base.groupBy("_key", x, y).agg(total.cast("double").alias("_m"))
        if init != "sample":
            with kept(base) as cached:
                return draw(cached, k, x, y, key, seed, mult)
    rows = base.select(F.col(key).cast("string"), x, y, F.col(mult).cast("double") if mult else F.lit(1.0)).collect()
    return recluster([tuple(r)[:3] for r in rows], [r[3] for r in rows], k, seed)


def fit_kmeans(points: DataFrame, k: int = 8, max_iter: int = 100, *, x: str = X, y: str = Y,
               key: str | None = None, weight: str | None = None,
               initial_centres: Sequence[Centre] | None = None, init: str = "sample",
               seed: int = DEFAULT_SEED, sample_target: int = DEFAULT_SAMPLE_TARGET,
               method: str = "blocks", scale: int = 6, storage: str = "persist",
               min_partitions: int | None = None, log=None) -> KMeansModel:
    """Fit K-Means with Lloyd iterations until no point moves or ``max_iter`` passes ran.

    ``points`` must already be cleaned (rows with a NULL/NaN coordinate are ignored). ``key`` names a
    unique row key for reproducible seeding; without one, seeding samples whole locations. ``weight``
    is an optional integer multiplicity column (duplicate folding). The final counts always come from
    the assignment to the final centres (V10). ``min_partitions`` repartitions the points before they
    are cached (for a small file that would be one partition); with ``storage="none"`` the caller
    keeps ``points`` cached itself and nothing is repartitioned. ``method``: ``"blocks"`` packs the points
    once more (``operators.blocks``), the others run ``lloyd_aggregate``; results are the same. Cached
    points and tables are released at the end.
    """
    t0 = time.perf_counter()
    cols = [c for c in (key, x, y, weight) if c]
    pts = points.select(*cols)
    if storage != "none" and min_partitions:
        pts = pts.repartition(min_partitions)
    with ExitStack() as held:
        pts = held.enter_context(kept(pts, storage, "points"))
        per_part = pts.groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1)).alias("r"), F.sum(F.col(weight).cast("long") if weight else F.lit(1)).alias("w"))
        totals = per_part.agg(F.sum("w").alias("w"), F.sum("r").alias("r"), F.count(F.lit(1)).alias("parts")).first()
        n_points, n_rows, n_parts = int(totals["w"] or 0), int(totals["r"] or 0), int(totals["parts"])
        if n_points == 0:
            raise ValueError("no valid points to cluster")
        load_time = time.perf_counter() - t0

        t1 = time.perf_counter()
        if initial_centres is not None:
            seeds = [(float(cx), float(cy)) for cx, cy in initial_centres]
            if len(seeds) != k:
                raise ValueError(f"{len(seeds)} initial centres given for K={k}")
        else:
            seeds = choose_seeds(pts, k, init, n_rows, x, y, key, weight, seed, sample_target)
        seed_time = time.perf_counter() - t1

        if method == "blocks":
            packed = held.enter_context(kept(pack_points(pts, x, y, weight, scale), "persist" if storage == "none" else storage, "packed"))

            def one_pass(now, before):
                return packed_step(packed, now, before, scale)
        else:
            def one_pass(now, before):
                return lloyd_step(pts, now, before, x, y, weight, method, scale)

        centres, prev = list(seeds), None
        counts: list[int] | None = None
        history: list[dict] = []
        converged = False
        for it in range(max_iter):
            ts = time.perf_counter()
            step = one_pass(centres, prev)
            elapsed = time.perf_counter() - ts
            history.append({"iteration": it, "n_moved": step.n_moved, "wcss": step.wcss_before, "wcss_after": step.wcss_after,
                            "iter_time_sec": elapsed, "pairs": step.pairs})
            if log:
                log(f"pass {it}: {step.n_moved} points changed cluster, sse {step.wcss_before:.6g}, {elapsed * 1e3:.0f} ms")
            prev, centres = centres, step.centres
            if step.n_moved == 0:
                # Same assignment as the previous pass, hence the same exact means: counts are final.
                converged, counts = True, step.counts
                break
        if counts is None:
            counts = one_pass(centres, None).counts
        return KMeansModel(centres=centres, counts=counts, seeds=seeds, history=history,
                           n_points=n_points, converged=converged, load_time_sec=load_time,
                           seed_time_sec=seed_time, n_partitions=n_parts, x=x, y=y)


def moved_points(points: DataFrame, centres: Sequence[Centre], prev_centres: Sequence[Centre],
                 x: str = X, y: str = Y) -> DataFrame:
    """Rows whose nearest centre differs between two centre sets (P10), with both ids."""
    s = nearest_struct(centres, x, y, prev_centres)
    return (points.withColumn("_a", s)
            .withColumn("cluster_id", F.col("_a.cluster_id"))
            .withColumn("prev_cluster", F.col("_a.prev_cluster"))
            .drop("_a")
            .filter(F.col("cluster_id") != F.col("prev_cluster")))
