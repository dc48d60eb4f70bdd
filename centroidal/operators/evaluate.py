"""Cluster quality and reports: WCSS (A3), point count (A4), cluster sizes (A6), result rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centroidal.functions.geometry import Centre
from centroidal.functions.numeric import exact_double_sum
from centroidal.operators.assign import X, Y, assign_nearest
from centroidal.operators.prefix import running_sum


def centres_frame(spark: SparkSession, centres: Sequence[Centre]) -> DataFrame:
    """K centres as ``cluster_id int, cx double, cy double`` (K rows from the driver)."""
    rows = [(i, float(cx), float(cy)) for i, (cx, cy) in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster_id int, cx double, cy double")


def wcss(points: DataFrame, centres: Sequence[Centre], x: str = X, y: str = Y, method: str = "arrow") -> DataFrame:
    """Within-cluster sum of squares and point count: one row ``wcss double, n_points bigint`` (A3, A4). The sum is
    the same for any partitioning (``exact_double_sum``)."""
    a = assign_nearest(points, centres, x, y, dist_col="sq_dist", method=method)
    return a.agg(exact_double_sum("sq_dist").alias("wcss"), F.count(F.lit(1)).alias("n_points"))


def wcss_per_cluster(points: DataFrame, centres: Sequence[Centre], x: str = X, y: str = Y,
                     method: str = "arrow") -> DataFrame:
    """Per cluster: ``cluster_id, n bigint, sse double`` (non-empty clusters)."""
    a = assign_nearest(points, centres, x, y, dist_col="sq_dist", method=method)
    return a.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), exact_double_sum("sq_dist").alias("sse"))


def cluster_sizes(assigned: DataFrame, centres: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Every centre with its size, 0 for an empty cluster.

    The assigned rows are aggregated first (K rows after the partial aggregation), then joined to the
    K centres, so the join never sees the points.
    """
    counts = assigned.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("cnt"))
    return (centres.join(counts, on=cluster_col, how="left")
            .select(*centres.columns, F.coalesce(F.col("cnt"), F.lit(0).cast("bigint")).alias("cnt")))


def order_by_cluster(assigned: DataFrame, order: Sequence[str], cluster_col: str = "cluster_id", out: str = "position") -> DataFrame:
    """Rows ordered by cluster id, then by ``order`` (T1), with their place from 1: a running count over a range sort."""
    placed = running_sum(assigned, F.lit(1), [cluster_col, *order], out)
    return placed.withColumn(out, F.col(out).cast("bigint"))


def result_rows(assigned: DataFrame, centres: DataFrame, x: str = X, y: str = Y,
                cluster_col: str = "cluster_id") -> DataFrame:
    """Each point with its cluster and that cluster's centre: ``x, y, cluster, centroid_x, centroid_y``.

    ``centres`` has one row per cluster, built from the K centres that the driver holds; that bounds the
    broadcast, and the points are never shuffled.
    """
    c = centres.select(F.col(cluster_col), F.col("cx").alias("centroid_x"), F.col("cy").alias("centroid_y"))
    return (assigned.join(F.broadcast(c), on=cluster_col, how="inner")
            .select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(cluster_col).alias("cluster"),
                    "centroid_x", "centroid_y"))
