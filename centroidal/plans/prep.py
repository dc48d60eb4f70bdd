"""Preparation as a command (S6, S7, J1, P6-P9, A7, U1, K7):

    python -m centroidal.plans.prep INPUT OUTPUT [--zones FILE] [--format parquet|csv] [--layout parquet|csv]

Reads a directory of trip files whose schemas may differ from file to file, turns zone ids into
coordinates (``--zones``) or finds coordinate columns by name, and writes ``OUTPUT/points`` (the
prepared points), ``OUTPUT/profile`` (raw, valid and rejected rows per file and in total).
"""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centroidal.operators.prepare import in_box, pad_columns, prep_profile, zone_lookup
from centroidal.session import get_session, kept
from centroidal.sinks.writers import write_prepared_csv
from centroidal.sources.points import X, Y, canonical_points, schema_groups
from centroidal.sources.zones import read_zones

ZONE_KEY = "PULocationID"


def trip_points(spark: SparkSession, path: str, zones: DataFrame | None = None, fmt: str = "parquet",
                key: str = ZONE_KEY) -> DataFrame:
    """Every row of a directory as ``file_tag``, coordinates (NULL where there are none) and ``valid``.

    With ``zones``, files that have the key column get the coordinates of their zone, whatever the
    column's type in each file; other files go by their coordinate columns and are valid inside the
    box. Files with neither have no valid row.
    """
    by_zone, by_name = [], []
    for group in schema_groups(spark, path, fmt):
        if zones is not None and key in group.columns:
            by_zone.append(group.select("file_tag", F.col(key).try_cast("int").alias("LocationID")))
            continue
        points = canonical_points(group, keep=["file_tag"])
        if points is None:
            missing = F.lit(None).cast("double")
            points = group.select("file_tag", missing.alias(X), missing.alias(Y))
        by_name.append(points.withColumn("valid", F.coalesce(in_box(), F.lit(False))))
    parts = by_name
    if by_zone:
        found = zone_lookup(reduce(DataFrame.unionByName, by_zone), zones, how="left")
        parts = [*parts, found.select("file_tag", F.col("longitude").alias(X), F.col("latitude").alias(Y),
                                      (F.col("longitude").isNotNull() & F.col("latitude").isNotNull()).alias("valid"))]
    if not parts:
        raise ValueError(f"no {fmt} files in {path}")
    return reduce(DataFrame.unionByName, parts)


def prepare(spark: SparkSession, path: str, output: str, zones: DataFrame | None = None, fmt: str = "parquet",
            layout: str = "parquet", key: str = ZONE_KEY) -> DataFrame:
    """Write the prepared points and the profile under ``output``; returns the profile as written."""
    if layout not in ("csv", "parquet"):
        raise ValueError(f"unknown layout {layout!r}; use 'parquet' or 'csv'")
    out = output.rstrip("/")
    # Files and zones are read and joined once: into a table of tagged rows, from which points and counts come.
    with kept(trip_points(spark, path, zones, fmt, key), "checkpoint", "prepared") as rows:
        valid = rows.filter("valid").select(X, Y)
        if layout == "csv":
            write_prepared_csv(valid, f"{out}/points")
        else:
            pad_columns(valid).write.mode("overwrite").parquet(f"{out}/points")
        profile = prep_profile(rows, "file_tag", F.col("valid"))
        profile.withColumn("rejected_rows", F.col("raw_rows") - F.col("valid_rows")).write.mode("overwrite").parquet(f"{out}/profile")
    return spark.read.parquet(f"{out}/profile")


def main(argv=None) -> int:
    p = argparse.ArgumentParser(description="Prepare trip files for clustering")
    p.add_argument("input", help="directory of trip files")
    p.add_argument("output")
    p.add_argument("--zones", default=None, help="zone table (LocationID, longitude, latitude), CSV or .parquet")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--layout", default="csv", choices=["parquet", "csv"])
    p.add_argument("--key", default=ZONE_KEY)
    args = p.parse_args(argv)
    spark = get_session(app_name="centroidal-prep")
    zones = read_zones(spark, args.zones, "parquet" if args.zones.endswith(".parquet") else "csv") if args.zones else None
    total = prepare(spark, args.input, args.output, zones, args.format, args.layout, args.key).filter("is_total").first()
    print(f"{total['raw_rows']} rows read, {total['valid_rows']} kept, {total['rejected_rows']} rejected")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
