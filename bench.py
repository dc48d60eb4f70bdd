"""Benchmark: headline K-Means runs and the registered queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: ``{"metric", "value", "unit", "queries", "sf", ...}``. ``value`` is the sum of
the per-query wall times in seconds. Fits run until no point moves (at most 100 passes, the
reference's limit) and report the median of three runs after a warm-up fit, with their loop time and
points per second per iteration (N x iterations / loop seconds, the reference's throughput
definition); the fit over about ten million rows runs once. Each DataFrame query is forced in full
with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from centroidal.operators.lloyd import fit_kmeans  # noqa: E402
from centroidal.operators.prepare import clean_points, fold_duplicates, zone_lookup  # noqa: E402
from centroidal.plans import catalog  # noqa: E402
from centroidal.session import get_session  # noqa: E402
from centroidal.sources import fixtures as FX  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = 3
#: Rows of the large fit: the line points again and again, each time moved by a tenth of a thousandth of a degree.
LARGE_ROWS = 10_000_000

# Registered queries timed at the bench scale (all of them; they are cheap at sf0.1).
QUERY_NAMES = sorted(catalog.QUERIES)


def sf_of(path: str):
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def force(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = get_session(f"local[{CPUS}]", CPUS)
    # Warm-up, not timed: the JVM, and one Python worker per task slot (Arrow batches in and out).
    spark.range(1000).agg(F.sum("id")).collect()
    spark.range(0, 1000, 1, CPUS).mapInArrow(lambda batches: batches, "id long").collect()

    queries: dict[str, float] = {}
    fits: dict[str, dict] = {}

    points = catalog.points(spark, SF_DIR)
    trips = clean_points(zone_lookup(FX.fx_trips(spark, SF_DIR), FX.fx_zones(spark)), "longitude", "latitude")

    def run_fit(name, df, k, repeats=REPEATS, **kw):
        runs = sorted((timed(lambda: fit_kmeans(df, k, 100, **kw)) for _ in range(repeats)), key=lambda r: r[0])
        sec, model = runs[len(runs) // 2]
        queries[name] = round(sec, 3)
        fits[name] = {
            "k": k, "n_points": model.n_points, "iterations": model.iterations, "converged": model.converged,
            "load_sec": round(model.load_time_sec, 3), "seed_sec": round(model.seed_time_sec, 3),
            "loop_sec": round(model.total_time_sec, 3),
            "pts_per_sec_per_iter": round(model.throughput_pts_sec),
            "final_wcss": model.final_wcss,
        }

    line_points = catalog.line_points(spark, SF_DIR)

    fit_kmeans(points, 8, 3, key="id")  # warm-up

    # Headline fits: the reference's job (K=8, sampled K-Means++, Lloyd until no point moves).
    run_fit("fit_points_k8", points, 8, key="id")
    run_fit("fit_points_k64", points, 64, key="id")
    run_fit("fit_line_points_k8", line_points, 8, key="id")
    run_fit("fit_line_points_k64", line_points, 64, key="id")
    run_fit("fit_trips_k8", trips, 8)
    run_fit("fit_trips_k8_folded", fold_duplicates(trips), 8, weight="weight")

    n = line_points.count()
    shift = F.explode(F.sequence(F.lit(0), F.lit(max(0, -(-LARGE_ROWS // n) - 1)))).alias("copy")
    large = line_points.select("id", catalog.X, catalog.Y, shift)
    large = large.select(F.concat_ws("-", "id", "copy").alias("id"), (F.col(catalog.X) + F.col("copy") * 1e-4).alias(catalog.X),
                         (F.col(catalog.Y) + F.col("copy") * 1e-4).alias(catalog.Y))
    run_fit("fit_large_k8", large, 8, repeats=1, key="id", min_partitions=CPUS * 4)

    for name in QUERY_NAMES:
        sec, _ = timed(lambda: force(catalog.QUERIES[name](spark, SF_DIR)))
        queries[name] = round(sec, 3)

    total = round(sum(queries.values()), 3)
    head = fits["fit_large_k8"]
    headline = {"fit": "fit_large_k8", "n_points": head["n_points"], "k": head["k"],
                "iterations": head["iterations"], "loop_sec": head["loop_sec"],
                "pts_per_sec_per_iter": head["pts_per_sec_per_iter"]}
    print(json.dumps({"metric": "total_query_sec", "value": total, "unit": "sec", "queries": queries,
                      "sf": sf_of(SF_DIR), "cpus": CPUS, "headline": headline, "fits": fits}))
    spark.stop()


if __name__ == "__main__":
    main()
