"""Run-history source (S8) with the ragged-row repair.

Run records come in two layouts under one 8-field header: 8 fields (``impl, K, threads, n_points,
iterations, elapsed_ms, wcss, throughput_pts_sec``) and, from GPU runs, 11 fields (the first five,
then ``h2d_ms, kmeans_ms, d2h_ms, elapsed_ms, wcss, throughput_pts_sec``). A header-driven CSV reader
silently cuts the long rows to 8 fields and reads host-to-device time as elapsed time. Here lines are
split and typed by their field count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from centroidal.sources.points import csv_fields

# The header of the run-record file and the two row layouts.
HEADER = "impl,K,threads,n_points,iterations,elapsed_ms,wcss,throughput_pts_sec"
SHORT_FIELDS = 8
LONG_FIELDS = 11

RUN_SCHEMA = ("run_id bigint, impl string, K int, threads string, n_points bigint, iterations int, "
              "h2d_ms double, kmeans_ms double, d2h_ms double, elapsed_ms double, wcss double, "
              "throughput_pts_sec double")
RUN_COLUMNS = ["run_id", "impl", "K", "threads", "n_points", "iterations", "h2d_ms", "kmeans_ms",
               "d2h_ms", "elapsed_ms", "wcss", "throughput_pts_sec"]


def parse_run_lines(lines: DataFrame, line_col: str = "value", order_col: str | None = None) -> DataFrame:
    """Type run-record lines by field count; header lines and lines of any other width are dropped.

    ``order_col`` (file order) becomes ``run_id``, the tie-breaker of "first run wins" rules.
    """
    order = [F.col(order_col).alias("_order")] if order_col else []
    text = F.trim(F.col(line_col))
    width = F.length(text) - F.length(F.replace(text, F.lit(","))) + 1
    staged = lines.select(*order, width.alias("_n"), csv_fields(text, LONG_FIELDS))
    n = F.col("_n")

    def at(i: int):
        return F.col(f"_f{i}")

    long_row = n == F.lit(LONG_FIELDS)
    # Positions of elapsed/wcss/throughput depend on the layout.
    def tail(short_i: int, long_i: int):
        return F.when(long_row, at(long_i)).otherwise(at(short_i)).try_cast("double")

    rid = F.col("_order").cast("bigint") if order_col else F.lit(None).cast("bigint")
    typed = staged.filter(n.isin(SHORT_FIELDS, LONG_FIELDS) & ~at(0).eqNullSafe(F.lit("impl"))).select(
        rid.alias("run_id"),
        at(0).alias("impl"),
        at(1).try_cast("int").alias("K"),
        at(2).alias("threads"),
        at(3).try_cast("bigint").alias("n_points"),
        at(4).try_cast("int").alias("iterations"),
        F.when(long_row, at(5).try_cast("double")).alias("h2d_ms"),
        F.when(long_row, at(6).try_cast("double")).alias("kmeans_ms"),
        F.when(long_row, at(7).try_cast("double")).alias("d2h_ms"),
        tail(5, 8).alias("elapsed_ms"),
        tail(6, 9).alias("wcss"),
        tail(7, 10).alias("throughput_pts_sec"),
    )
    return typed


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file_no, line_no, value`` of text files, read in splits: lines count from 0 in their file, files in the order
    of the given paths and then of their names.

    A line's number is the lines of the file's earlier splits and its place in its split; Spark reads the lines of a
    split in order, in one task. Lines with neither text nor a comma still count.
    """
    paths = [path] if isinstance(path, str) else list(path)
    parts = [spark.read.text(p).select(
        F.lit(i).alias("given"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value") for i, p in enumerate(paths)]
    lines = reduce(DataFrame.unionByName, parts)
    counts = lines.groupBy("given", "file", "start").agg(F.count(F.lit(1)).alias("n"))
    # one row a split; files by number, splits by the lines before them
    earlier = Window.partitionBy("given", "file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    files = counts.select("given", "file").distinct().withColumn("file_no", F.row_number().over(Window.orderBy("given", "file")) - 1)
    splits = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(files, ["given", "file"])
    place = F.row_number().over(Window.partitionBy("given", "file", "start").orderBy("at")) - 1
    return lines.withColumn("place", place).join(splits.select("given", "file", "start", "file_no", "before"), ["given", "file", "start"]) \
        .select("file_no", (F.col("before") + F.col("place")).alias("line_no"), "value")


def read_run_history(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Read run-record CSV files (8- and 11-field rows) into the typed run table.

    ``run_id`` (file number x 2^32 + line number) follows the order of the given paths, then of the file names in a
    folder, then of the lines, which is what the reference's "first row wins" tie rule needs.
    """
    lines = numbered_lines(spark, path)
    return parse_run_lines(lines.select("value", (F.col("file_no") * F.lit(1 << 32) + F.col("line_no")).alias("_at")), "value", "_at")


def run_record_lines(runs: DataFrame) -> DataFrame:
    """Inverse of ``parse_run_lines`` for writing: one text line per run, 11 fields for GPU rows (K3, K4)."""
    def fmt(c, spec):
        return F.format_string(spec, F.col(c))
    short = F.concat_ws(",", F.col("impl"), F.col("K").cast("string"), F.col("threads"),
                        F.col("n_points").cast("string"), F.col("iterations").cast("string"),
                        fmt("elapsed_ms", "%.2f"), fmt("wcss", "%.4e"), fmt("throughput_pts_sec", "%.0f"))
    long = F.concat_ws(",", F.col("impl"), F.col("K").cast("string"), F.col("threads"),
                       F.col("n_points").cast("string"), F.col("iterations").cast("string"),
                       fmt("h2d_ms", "%.2f"), fmt("kmeans_ms", "%.2f"), fmt("d2h_ms", "%.2f"),
                       fmt("elapsed_ms", "%.2f"), fmt("wcss", "%.4e"), fmt("throughput_pts_sec", "%.0f"))
    return runs.select(F.when(F.col("h2d_ms").isNotNull(), long).otherwise(short).alias("value"))
