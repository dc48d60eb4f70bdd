"""Sinks (K1-K8). Every writer is a DataFrame write, so output is a directory of part files written in
parallel; nothing is gathered on the driver except the K-row centre and one-row run records that
the fit already holds there.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centroidal.functions.formatting import fixed
from centroidal.functions.numeric import round_half_up
from centroidal.operators.lloyd import KMeansModel
from centroidal.operators.prepare import pad_columns
from centroidal.sources.history import HEADER, RUN_COLUMNS, run_record_lines

X, Y = "pickup_longitude", "pickup_latitude"


def write_assignments(assigned: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Assignments as Parquet: ``pickup_longitude, pickup_latitude, cluster_id`` (K1)."""
    assigned.select(X, Y, F.col("cluster_id").cast("int")).write.mode(mode).parquet(path)


def write_result_rows(rows: DataFrame, path: str, decimals: int = 6, mode: str = "overwrite") -> None:
    """Result rows ``x, y, cluster, centroid_x, centroid_y`` as CSV with a header, fixed decimals.

    Coordinates are first rounded by the rule of ``functions.numeric`` (``floor(v * 10^decimals + 0.5)``), so that any
    formatter prints the same text; a C stream, which rounds the exact binary value half to even, can differ from it in
    the last digit only where the value lies exactly between two texts.
    """
    def text(c: str):
        return fixed(round_half_up(c, decimals), decimals).alias(c)

    out = rows.select(text("x"), text("y"), F.col("cluster").cast("string").alias("cluster"), text("centroid_x"), text("centroid_y"))
    out.write.mode(mode).option("header", True).csv(path)


def append_run_records(runs: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append run records (K3, K4).

    ``parquet``: the typed run table (nullable GPU timing columns), one schema for every run kind.
    ``csv``: the text layout of the reference - 8 fields, or 11 for rows with GPU timings. Each part file starts with
    the header, so each reads on its own, and a table of runs is written by as many tasks as it has partitions.
    """
    cols = [c for c in RUN_COLUMNS if c in runs.columns]
    if fmt == "parquet":
        runs.select(*cols).write.mode("append").parquet(path)
        return
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    # One text column named by the header line; the separator stands in neither, so nothing is quoted.
    lines = run_record_lines(runs).withColumnRenamed("value", HEADER)
    lines.write.mode("append").option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(path)


def centroid_record(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """``{k, centroids: [{id, x, y, count}]}`` as a one-row DataFrame (K5); centroids ordered by id."""
    cen = model.centres_frame(spark).select(
        F.struct(F.col("cluster_id").alias("id"), F.col("cx").alias("x"), F.col("cy").alias("y"),
                 F.col("cnt").alias("count")).alias("c"))
    return cen.agg(F.array_sort(F.collect_list("c")).alias("centroids")).select(
        F.lit(model.k).alias("k"), "centroids")


def write_centroid_record(spark: SparkSession, model: KMeansModel, path: str, mode: str = "overwrite") -> None:
    """Write the centroid record as JSON (K5; the reference builds it but never writes it)."""
    centroid_record(spark, model).coalesce(1).write.mode(mode).json(path)


def experiment_record(spark: SparkSession, model: KMeansModel, impl: str = "spark",
                      n_nodes: int | None = None) -> DataFrame:
    """One-row experiment record (K6): run settings, times, WCSS, throughput, per-iteration lists and
    the centroids. ``n_nodes`` defaults to the session's default parallelism (task slots)."""
    h = model.history
    per_iter = F.struct(
        F.array(*[F.lit(int(r["iteration"])) for r in h]).cast("array<int>").alias("iterations"),
        F.array(*[F.lit(float(r["wcss"])) for r in h]).cast("array<double>").alias("wcss"),
        F.array(*[F.lit(float(r["iter_time_sec"])) for r in h]).cast("array<double>").alias("iter_time_sec"),
        F.array(*[F.lit(int(r["n_moved"])) for r in h]).cast("array<bigint>").alias("n_moved"),
    )
    nodes = n_nodes if n_nodes is not None else spark.sparkContext.defaultParallelism
    cen = centroid_record(spark, model)
    return cen.select(
        F.lit(impl).alias("impl"), F.lit(int(nodes)).alias("n_nodes"),
        F.lit(int(model.n_partitions)).alias("n_partitions"), F.lit(model.k).alias("K"),
        F.lit(int(model.n_points)).cast("bigint").alias("n_points"), F.lit(model.iterations).alias("iterations"),
        F.lit(float(model.total_time_sec)).alias("total_time_sec"),
        F.lit(float(model.load_time_sec)).alias("load_time_sec"),
        F.lit(model.final_wcss).cast("double").alias("final_wcss"),
        F.lit(float(model.throughput_pts_sec)).alias("throughput_pts_sec"),
        per_iter.alias("per_iter_metrics"), F.col("centroids"))


def write_experiment_record(spark: SparkSession, model: KMeansModel, path: str, impl: str = "spark",
                            n_nodes: int | None = None) -> None:
    """Append the experiment record as JSON (K6; the reference only prints it)."""
    experiment_record(spark, model, impl, n_nodes).coalesce(1).write.mode("append").json(path)


def run_record(spark: SparkSession, model: KMeansModel, impl: str = "spark", threads: str | None = None) -> DataFrame:
    """The model's run as one row of the run table (K3 layout; GPU timing columns NULL). ``run_id`` is the
    time of writing in microseconds, so the first of several runs is the one recorded first."""
    t = threads if threads is not None else str(spark.sparkContext.defaultParallelism)
    # Microseconds since the epoch: later runs have greater ids, so appended records keep their order.
    row = [(time.time_ns() // 1000, impl, model.k, t, int(model.n_points), model.iterations, None, None, None,
            float(model.total_time_sec * 1000.0), model.final_wcss, float(model.throughput_pts_sec))]
    return spark.createDataFrame(row, "run_id bigint, impl string, K int, threads string, n_points bigint, "
                                      "iterations int, h2d_ms double, kmeans_ms double, d2h_ms double, "
                                      "elapsed_ms double, wcss double, throughput_pts_sec double")


def write_history(spark: SparkSession, model: KMeansModel, path: str, mode: str = "overwrite") -> None:
    """Per-iteration history rows (K8) as Parquet."""
    model.history_frame(spark).write.mode(mode).parquet(path)


def write_prepared_csv(points: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Prepared points in the padded layout ``col_0..col_4, pickup_longitude, pickup_latitude`` (K7)."""
    pad_columns(points).write.mode(mode).option("header", True).csv(path)
