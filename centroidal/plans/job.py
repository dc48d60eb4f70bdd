"""``spark-submit`` entry point: the whole clustering job.

    spark-submit --py-files centroidal.zip -m centroidal.plans.job \\
        --input s3a://bucket/trips/ --format parquet --output s3a://bucket/out/ --k 8

Stages: read (S1-S6) -> clean (P1-P3) -> optional zone lookup (J1) -> optional row limit (T2) ->
optional repartition (X7) -> fit (seeding X1-X3, Lloyd X4/X5 with the points cached, X8) ->
predict and write assignments (K1) -> centroid record (K5), experiment record (K6), run record (K3),
iteration history (K8). Only K-row and one-row results reach the driver.
"""

from __future__ import annotations

import argparse
import logging
import sys

from centroidal.operators.lloyd import fit_kmeans
from centroidal.operators.prepare import clean_points, fold_duplicates, limit_points, repartition_points, zone_lookup
from centroidal.session import get_session, kept
from centroidal.sinks.writers import (
    append_run_records, run_record, write_assignments, write_centroid_record, write_experiment_record,
    write_history,
)
from centroidal.sources.points import find_coordinate_columns, read_points, read_positional_csv
from centroidal.sources.zones import read_zones

log = logging.getLogger("centroidal.job")


def parse_args(argv=None):
    p = argparse.ArgumentParser(description="K-Means clustering of point data on Spark")
    p.add_argument("--input", required=True, help="file or directory (any Hadoop URI)")
    p.add_argument("--output", default="output_kmeans", help="output directory")
    p.add_argument("--format", default="csv", choices=["csv", "parquet", "positional"],
                   help="csv (header, named columns), parquet, or positional csv (fields by index)")
    p.add_argument("--k", type=int, default=8)
    p.add_argument("--max_iter", type=int, default=100)
    p.add_argument("--n_parts", type=int, default=None, help="repartition the cleaned points")
    p.add_argument("--max_rows", type=int, default=-1, help="keep at most this many accepted rows (<=0: all)")
    p.add_argument("--x", default="pickup_longitude")
    p.add_argument("--y", default="pickup_latitude")
    p.add_argument("--col_x", type=int, default=5, help="field index of x for --format positional")
    p.add_argument("--col_y", type=int, default=6, help="field index of y for --format positional")
    p.add_argument("--key", default=None, help="unique row key column (reproducible seeding)")
    p.add_argument("--zones", default=None, help="zone table (LocationID, longitude, latitude); input then "
                                                  "needs a PULocationID column")
    p.add_argument("--init", default="sample", choices=["sample", "kmeans++", "kmeans||"])
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--method", default="blocks", choices=["blocks", "partials", "arrow", "expr"])
    p.add_argument("--scale", type=int, default=6, help="decimals of the exact coordinate sums")
    p.add_argument("--fold", action="store_true", help="fold duplicate locations (exact, weighted Lloyd)")
    p.add_argument("--storage", default="persist", choices=["persist", "checkpoint"],
                   help="keep the cleaned points cached, or checkpointed to spark.checkpoint.dir")
    p.add_argument("--shuffle_partitions", type=int, default=None,
                   help="spark.sql.shuffle.partitions for this job (AQE coalesces from there); size it to the "
                        "largest shuffle, the duplicate folding, at about 128 MB per partition")
    return p.parse_args(argv)


def run(args, spark=None):
    spark = spark or get_session(app_name="centroidal-kmeans")
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.format == "positional":
        raw = read_positional_csv(spark, args.input, args.col_x, args.col_y)
        x, y = "pickup_longitude", "pickup_latitude"
    else:
        raw = read_points(spark, args.input, args.format)
        x, y = args.x, args.y
        if not args.zones and (x not in raw.columns or y not in raw.columns):
            found = find_coordinate_columns(raw.columns)   # P6: older files name them differently
            if found is None:
                raise ValueError(f"no coordinate columns in {raw.columns}; pass --x and --y")
            x, y = found
    if args.zones:
        zones = read_zones(spark, args.zones, "parquet" if args.zones.endswith(".parquet") else "csv")
        raw = zone_lookup(raw.withColumnRenamed("PULocationID", "LocationID"), zones)
        x, y = "longitude", "latitude"
    keep = [args.key] if args.key else []
    pts = clean_points(raw, x, y, keep=keep)
    pts = limit_points(pts, args.max_rows, order_by=[args.key] if args.key else None)
    pts = repartition_points(pts, args.n_parts)
    # Cache the cleaned points once: the fit iterates over them and the final assignment reads them
    # again, so the source is scanned and cleaned a single time.
    with kept(pts, args.storage, "points") as pts:
        if args.fold:
            model = fit_kmeans(fold_duplicates(pts), args.k, args.max_iter, weight="weight", init=args.init,
                               seed=args.seed, method=args.method, scale=args.scale, log=log.info)
        else:
            model = fit_kmeans(pts, args.k, args.max_iter, key=args.key, init=args.init, seed=args.seed,
                               method=args.method, scale=args.scale, storage="none", log=log.info)
        out = args.output.rstrip("/")
        write_assignments(model.predict(pts), f"{out}/assignments")
        write_centroid_record(spark, model, f"{out}/centroids")
        write_experiment_record(spark, model, f"{out}/experiments")
        append_run_records(run_record(spark, model), f"{out}/metrics")
        write_history(spark, model, f"{out}/history")
        return model


def report(model) -> list[str]:
    """Closing lines of a run: a summary and one line per final centre."""
    state = "settled" if model.converged else "stopped at the pass limit"
    lines = [f"{model.n_points} points in {model.k} clusters, {state} after {model.iterations} passes "
             f"({model.total_time_sec:.3f} s, {model.throughput_pts_sec:.4g} points/s)"]
    if model.final_wcss is not None:
        lines.append(f"sum of squared distances {model.final_wcss:.6g}")
    lines += [f"centre {i}: x={cx:.6f} y={cy:.6f} n={n}" for i, ((cx, cy), n) in enumerate(zip(model.centres, model.counts))]
    return lines


def main(argv=None):
    logging.basicConfig(level=logging.INFO, format="%(name)s %(message)s")
    print("\n".join(report(run(parse_args(argv)))))
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
