"""Run-history analysis as a command.

    python -m centroidal.plans.analyze RUNS [--format text|parquet] [--output DIR]

Reads run records (8/11-field text files or the typed Parquet table), then:
- prints the run count, the implementations, the strong-scaling table (one row per thread count)
  and the Amdahl estimate, formatted like a report;
- with ``--output``, writes every table (strong scaling, weak scaling, chart table, speedup over
  serial, best throughput) as CSV directories.

The tables are Spark jobs over the run table; only the per-thread-count tables are collected for
printing. The weak-scaling table (one row per parallel run) is written, not printed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centroidal.functions.formatting import fixed, percent, thousands, times
from centroidal.operators import history as H
from centroidal.session import get_session
from centroidal.sources.history import read_run_history


def report_table(scaling: DataFrame) -> DataFrame:
    """Strong-scaling rows as report text: threads, time, speedup, efficiency, throughput."""
    return (scaling.orderBy("row_order")
            .select(F.col("threads").alias("Threads"), fixed("mean_ms", 1).alias("Time (ms)"),
                    times("speedup", 2).alias("Speedup"), percent("efficiency", 1).alias("Efficiency"),
                    thousands("throughput", 0).alias("Throughput (pts/s)")))


def analyze(spark, runs: DataFrame, output: str | None = None, out=None, baseline: str = H.SERIAL,
            compared: str = H.PARALLEL) -> dict:
    """Print the report and return its tables; ``baseline`` and ``compared`` name the implementations of the
    scaling tables (the job's own records are ``spark``)."""
    out = out if out is not None else sys.stdout    # resolved per call, not at import
    summary = runs.agg(F.count(F.lit(1)).alias("n_runs"),
                       F.array_sort(F.collect_set("impl")).alias("impls")).first()
    print(f"Runs: {summary['n_runs']}", file=out)
    print(f"Implementations: {', '.join(summary['impls'])}", file=out)
    strong = H.strong_scaling(runs, baseline, compared)
    table = report_table(strong)
    rows = table.collect()
    if rows:
        print("\nSTRONG SCALING", file=out)
        print("  " + " | ".join(f"{c:>16}" for c in table.columns), file=out)
        for r in rows:
            print("  " + " | ".join(f"{v:>16}" for v in r), file=out)
        a = H.amdahl(strong).first()
        if a is not None:
            print(f"\n  Amdahl parallel fraction: {a['parallel_fraction'] * 100:.1f}%", file=out)
            if a["limit"] is not None:
                print(f"  Maximum speedup: {a['limit']:.1f}x", file=out)
    else:
        print(f"\nNo {baseline} and {compared} runs to compare.", file=out)
    tables = {
        "strong_scaling": strong,
        "weak_scaling": H.weak_scaling(runs, compared),
        "chart_scaling": H.strong_scaling(runs, baseline, compared, same_n=False),
        "impl_speedup": H.impl_speedup(runs, baseline),
        "best_throughput": H.best_throughput(runs),
    }
    if output:
        for name, df in tables.items():
            df.write.mode("overwrite").option("header", True).csv(f"{output.rstrip('/')}/{name}")
        print(f"\nTables written to {output}", file=out)
    return tables


def main(argv=None) -> int:
    p = argparse.ArgumentParser(description="Analyse K-Means run records")
    p.add_argument("runs", help="run-record files or directory")
    p.add_argument("--format", default="text", choices=["text", "parquet"])
    p.add_argument("--output", default=None, help="directory for the CSV tables")
    p.add_argument("--baseline", default=H.SERIAL, help="implementation of the baseline run")
    p.add_argument("--compared", default=H.PARALLEL, help="implementation of the scaling runs, e.g. spark")
    args = p.parse_args(argv)
    spark = get_session(app_name="centroidal-analyze")
    runs = read_run_history(spark, args.runs) if args.format == "text" else spark.read.parquet(args.runs)
    analyze(spark, runs, args.output, baseline=args.baseline, compared=args.compared)
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
