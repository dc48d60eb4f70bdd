"""Run-history analysis.

Input: the typed run table of ``sources.history`` (``run_id, impl, K, threads, n_points, iterations,
h2d_ms, kmeans_ms, d2h_ms, elapsed_ms, wcss, throughput_pts_sec``). Every operator is a grouped
aggregate or an equi-join against an aggregate of a few rows; scalars such as the baseline time are
scalar subqueries (``DataFrame.scalar()``) evaluated by Spark, never loops over collected rows. The scaling tables
(H1, H4, F8) scan the runs once, into ``run_groups``, and read that small table several times.
Mean and total times are exact sums at microsecond resolution (``exact_mean``), so they do not depend
on partitioning or summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centroidal.functions.geometry import exact_mean, exact_sum, exact_total, mean_from_exact
from centroidal.functions.metrics import (
    amdahl_limit, amdahl_parallel_fraction, is_digits, parallel_efficiency, speedup, threads_numeric,
    throughput, weak_efficiency,
)
from centroidal.session import ensure_checkpoint_dir

# Implementation names and the label of the baseline row in the strong-scaling table.
SERIAL = "serial"
PARALLEL = "openmp"
SERIAL_LABEL = "1 (serial)"


def run_groups(runs: DataFrame) -> DataFrame:
    """One row per ``impl, n_points, threads``: exact time sum and count, run count and the first run. The reports that
    need several views of the history build on it, so they scan the run table once."""
    return runs.groupBy("impl", "n_points", "threads").agg(
        exact_sum("elapsed_ms").alias("units"), F.count("elapsed_ms").alias("timed"), F.count(F.lit(1)).alias("n_runs"),
        F.min_by(F.struct("run_id", "elapsed_ms", "iterations"), "run_id").alias("first"))


def baseline_run(runs: DataFrame, impl: str = SERIAL) -> DataFrame:
    """The run of ``impl`` with the greatest N; the first in file order (least ``run_id``) on ties.

    One row: ``base_n, base_ms, base_iterations``. A global ``min_by`` aggregate, so each task sends
    one partial row.
    """
    return _baseline(run_groups(runs), impl)


def _baseline(groups: DataFrame, impl: str) -> DataFrame:
    best = F.min_by(F.struct("n_points", "first"), F.struct((-F.col("n_points")).alias("neg_n"), F.col("first.run_id")))
    return (groups.filter(F.col("impl") == impl).agg(best.alias("b"))
            .filter(F.col("b").isNotNull())
            .select(F.col("b.n_points").alias("base_n"), F.col("b.first.elapsed_ms").alias("base_ms"),
                    F.col("b.first.iterations").alias("base_iterations")))


def mean_by_threads(runs: DataFrame, impl: str = PARALLEL) -> DataFrame:
    """Mean elapsed time per thread count of ``impl`` (A9): ``n_points, threads, mean_ms, n_runs``."""
    return (runs.filter(F.col("impl") == impl)
            .groupBy("n_points", "threads")
            .agg(exact_mean("elapsed_ms").alias("mean_ms"), F.count(F.lit(1)).alias("n_runs")))


def strong_scaling(runs: DataFrame, serial: str = SERIAL, parallel: str = PARALLEL,
                   same_n: bool = True) -> DataFrame:
    """Strong-scaling table (H1; ``same_n=False`` gives the chart variant of H4).

    Baseline = serial run with the greatest N. With ``same_n`` only parallel runs at that N count (P11,
    an equi-join on N with the one-row baseline); the chart variant takes all N, but only numeric thread
    counts. Per thread count: mean time, speedup = baseline /
    mean, efficiency = speedup / threads x 100, throughput = N x baseline iterations / seconds. The
    serial row comes first (U2). Columns: ``row_order, threads, mean_ms, speedup, efficiency,
    throughput``; ``row_order`` is 0 for the serial row, then the numeric thread count (T4).
    """
    ensure_checkpoint_dir(runs.sparkSession)
    groups = run_groups(runs).checkpoint()  # the only scan of the runs; its files go with the frame
    base = _baseline(groups, serial)
    every = groups.filter(F.col("impl") == parallel)
    if same_n:
        par = every.join(base.select(F.col("base_n").alias("n_points")), on="n_points", how="left_semi")
    else:
        par = every.filter(is_digits("threads"))
    grouped = par.groupBy("threads").agg(mean_from_exact(F.sum("units"), F.sum("timed")).alias("mean_ms"))
    # The baseline is one row: attach it as one scalar subquery (no join, no cross product).
    b = base.select(F.struct("base_ms", "base_n", "base_iterations")).scalar()
    base_ms, base_n, base_it = b["base_ms"], b["base_n"], b["base_iterations"]
    rows = grouped.select(
        threads_numeric("threads").alias("row_order"),
        F.col("threads"),
        F.col("mean_ms"),
        speedup(base_ms, F.col("mean_ms")).alias("speedup"),
        parallel_efficiency(speedup(base_ms, F.col("mean_ms")), F.col("threads")).alias("efficiency"),
        throughput(base_n, base_it, F.col("mean_ms")).alias("throughput"),
    )
    serial_row = base.select(
        F.lit(0).alias("row_order"), F.lit(SERIAL_LABEL).alias("threads"), F.col("base_ms").alias("mean_ms"),
        F.lit(1.0).alias("speedup"), F.lit(100.0).alias("efficiency"),
        throughput(F.col("base_n"), F.col("base_iterations"), F.col("base_ms")).alias("throughput"))
    # Nothing unless both kinds of runs exist; the serial row stands even if no parallel run has its N.
    has_parallel = every.select(F.count(F.lit(1))).scalar() > 0
    return serial_row.filter(has_parallel).unionByName(rows.filter(base_ms.isNotNull()))


def amdahl(scaling: DataFrame) -> DataFrame:
    """Amdahl estimate from a strong-scaling table (F8): one row ``max_speedup, max_threads,
    n_points_used, parallel_fraction, limit``.

    Uses the parallel rows only (not the serial row); S and n are the separate maxima, as in the
    reference; needs at least two rows, else no row.
    """
    par = scaling.filter(F.col("threads") != F.lit(SERIAL_LABEL))
    agg = par.agg(F.max("speedup").alias("max_speedup"), F.max("row_order").alias("max_threads"),
                  F.count(F.lit(1)).alias("n_points_used"))
    p = amdahl_parallel_fraction(F.col("max_speedup"), F.col("max_threads"))
    return (agg.filter(F.col("n_points_used") >= 2)
            .select("max_speedup", "max_threads", "n_points_used", p.alias("parallel_fraction"))
            .withColumn("limit", amdahl_limit(F.col("parallel_fraction"))))


def weak_scaling(runs: DataFrame, parallel: str = PARALLEL, proportional_only: bool = False,
                 points_per_thread: int | None = None) -> DataFrame:
    """Weak-scaling efficiency of every parallel run (H2): base = least time of a one-thread run.

    As in the reference all parallel runs are listed (runs of strong-scaling sets included); with
    ``proportional_only`` only runs whose N equals ``points_per_thread`` x threads are kept (L7).
    Columns: ``run_id, threads, n_points, elapsed_ms, efficiency``.
    """
    par = runs.filter(F.col("impl") == parallel)
    base_ms = par.filter(F.col("threads") == "1").select(F.min("elapsed_ms")).scalar()
    out = par.filter(base_ms.isNotNull())
    if proportional_only:
        if not points_per_thread:
            raise ValueError("proportional_only needs points_per_thread")
        out = out.filter(is_digits("threads") &
                         (F.col("n_points") == F.col("threads").try_cast("bigint") * F.lit(points_per_thread)))
    return out.select("run_id", "threads", "n_points", "elapsed_ms",
                      weak_efficiency(base_ms, F.col("elapsed_ms")).alias("efficiency"))


def impl_speedup(runs: DataFrame, baseline_impl: str = SERIAL) -> DataFrame:
    """Speedup of every other implementation over ``baseline_impl`` at equal (K, N) (H3).

    Both sides are first reduced to one mean time per (impl, K, N); the equi-join then pairs groups,
    never individual runs. Columns: ``impl, K, n_points, baseline_ms, impl_ms, speedup``.
    """
    means = runs.groupBy("impl", "K", "n_points").agg(exact_mean("elapsed_ms").alias("mean_ms"))
    base = means.filter(F.col("impl") == baseline_impl).select("K", "n_points", F.col("mean_ms").alias("baseline_ms"))
    other = means.filter(F.col("impl") != baseline_impl).withColumnRenamed("mean_ms", "impl_ms")
    return (other.join(base, on=["K", "n_points"], how="inner")
            .select("impl", "K", "n_points", "baseline_ms", "impl_ms",
                    speedup(F.col("baseline_ms"), F.col("impl_ms")).alias("speedup")))


def best_throughput(runs: DataFrame) -> DataFrame:
    """Per implementation: best throughput, least time, least one-thread time (A10).

    Columns: ``impl, n_runs, best_throughput, min_elapsed_ms, min_single_thread_ms``.
    """
    return runs.groupBy("impl").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.max("throughput_pts_sec").alias("best_throughput"),
        F.min("elapsed_ms").alias("min_elapsed_ms"),
        F.min(F.when(F.col("threads") == "1", F.col("elapsed_ms"))).alias("min_single_thread_ms"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Run count, distinct implementations, total points processed, total time (A11): one row."""
    return runs.agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_distinct("impl").alias("n_impls"),
        F.sum(F.col("n_points") * F.col("iterations")).alias("points_processed"),
        exact_total("elapsed_ms").alias("total_elapsed_ms"))


def recomputed_throughput(runs: DataFrame) -> DataFrame:
    """Each run with ``N x iterations / seconds`` next to the recorded throughput (consistency check)."""
    return runs.withColumn("throughput_check", throughput("n_points", "iterations", "elapsed_ms"))
