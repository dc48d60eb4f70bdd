"""Schemas read in tasks (S6), one evaluation of a preparation (A7, P4), split run histories (S8), one scan of
the runs (H1), text records (K3), K-Means‖ (X3)."""

import csv
import glob
import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from centroidal.operators import history as H
from centroidal.operators.lloyd import fit_kmeans
from centroidal.operators.seed import kmeans_parallel, kmeanspp
from centroidal.plans import catalog
from centroidal.plans.prep import prepare
from centroidal.session import ensure_checkpoint_dir
from centroidal.sinks.writers import append_run_records
from centroidal.sources import fixtures as FX
from centroidal.sources.history import HEADER, numbered_lines, read_run_history
from centroidal.sources.points import file_schemas, read_point_directory, schema_groups

from conftest import SF0001


class jobs:
    """Spark jobs started in a ``with`` block."""

    def __init__(self, spark):
        self.sc, self.group = spark.sparkContext, uuid.uuid4().hex

    def __enter__(self):
        self.sc.setJobGroup(self.group, "counted")
        return self

    def __exit__(self, *_):
        self.count = len(self.sc.statusTracker().getJobIdsForGroup(self.group))
        self.sc.setLocalProperty("spark.jobGroup.id", None)


def test_schemas_of_many_files_in_one_job(spark, tmpdir_run):
    kinds = [{"Start_Lon": pa.float64(), "Start_Lat": pa.float64()}, {"pickup_longitude": pa.string(), "pickup_latitude": pa.string()},
             {"PULocationID": pa.int32()}, {"PULocationID": pa.int64()}]
    for k in range(400):
        kind = kinds[k % 4]
        pq.write_table(pa.table({n: pa.array([k % 50], pa.int32()).cast(t) for n, t in kind.items()}), f"{tmpdir_run}/f{k:04d}.parquet")
    with jobs(spark) as counted:
        rows = file_schemas(spark, tmpdir_run).groupBy("schema").count().collect()
    assert sorted(r["count"] for r in rows) == [100] * 4 and counted.count <= 3
    with jobs(spark) as counted:
        groups = schema_groups(spark, tmpdir_run)
    assert len(groups) == 4 and counted.count <= 20  # some jobs a schema, none a file
    points, skipped = read_point_directory(spark, tmpdir_run)
    assert points.count() == 200 and len(skipped) == 200 and points.select("file_tag").distinct().count() == 200


def test_csv_headers_are_read_in_tasks(spark, tmpdir_run):
    for k, header in enumerate(("a,lat,lon", "lon,x,lat", "a,lat,lon", "nothing")):
        with open(f"{tmpdir_run}/{k}.csv", "w") as f:
            f.write(f"{header}\n1,2,3\n")
    points, skipped = read_point_directory(spark, tmpdir_run, "csv")
    got = sorted((r["pickup_longitude"], r["pickup_latitude"]) for r in points.collect())
    assert got == [(1.0, 3.0), (3.0, 2.0), (3.0, 2.0)] and [os.path.basename(s) for s in skipped] == ["3.csv"]


def test_counts_of_every_file(spark, tmpdir_run):
    want = {}
    for k in range(6):
        os.makedirs(f"{tmpdir_run}/in/d{k % 2}", exist_ok=True)
        lon = [-74.0] * (k + 1) + [0.0] * k + [None] * 2
        pq.write_table(pa.table({"lon": pa.array(lon, pa.float64()), "lat": pa.array([40.5] * len(lon))}), f"{tmpdir_run}/in/d{k % 2}/f{k}.parquet")
        want[f"d{k % 2}/f{k}.parquet"] = (len(lon), k + 1, len(lon) - k - 1)
    before = set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))
    profile = prepare(spark, f"{tmpdir_run}/in", f"{tmpdir_run}/out")
    rows = {r["file_tag"]: (r["raw_rows"], r["valid_rows"], r["rejected_rows"]) for r in profile.collect()}
    assert rows.pop(None) == tuple(map(sum, zip(*want.values()))) and rows == want
    assert spark.read.parquet(f"{tmpdir_run}/out/points").count() == sum(v for _, v, _ in want.values())
    assert set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:"))) == before  # the tagged rows are gone
    with pytest.raises(ValueError):
        prepare(spark, f"{tmpdir_run}/in", f"{tmpdir_run}/out2", layout="orc")


def test_lines_are_numbered_over_splits(spark, tmpdir_run):
    texts = {"b": [f"line {k} " + "x" * (k % 90) for k in range(3000)], "a": ["one", "", "three"]}
    for name, lines in texts.items():
        with open(f"{tmpdir_run}/{name}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert spark.read.text(f"{tmpdir_run}/b.txt").rdd.getNumPartitions() > 3
        rows = sorted((r["file_no"], r["line_no"], r["value"]) for r in numbered_lines(spark, tmpdir_run).collect())
        assert rows == [(n, k, v) for n, name in enumerate("ab") for k, v in enumerate(texts[name])]
        given = numbered_lines(spark, [f"{tmpdir_run}/b.txt", f"{tmpdir_run}/a.txt"]).filter("line_no = 0").collect()
        assert {r["file_no"]: r["value"] for r in given} == {0: texts["b"][0], 1: "one"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_odd_lines_of_a_history(spark, tmpdir_run):
    lines = [HEADER, "serial,8,1,100,2,1.50,1.0e+03,9", "", "a,b", "  openmp,8,4,100,2,,bad,9  ", "cuda,8,GPU,5,1,1,2,3,6,7,8", ",8,1,1,1,1,1,1",
             '"q",8,1,1,1,1,1,1', ",".join("x" * 12), ",".join("y" * 9)]
    with open(f"{tmpdir_run}/m.csv", "w") as f:
        f.write("\r\n".join(lines))
    rows = {r["run_id"]: r for r in read_run_history(spark, tmpdir_run).collect()}
    assert sorted(rows) == [1, 4, 5, 6, 7]
    assert rows[4]["impl"] == "openmp" and rows[4]["elapsed_ms"] is None and rows[4]["wcss"] is None and rows[4]["throughput_pts_sec"] == 9
    assert (rows[5]["h2d_ms"], rows[5]["elapsed_ms"], rows[5]["wcss"]) == (1, 6, 7) and rows[7]["impl"] == '"q"'


def test_every_text_part_has_its_header(spark, tmpdir_run):
    runs = FX.fx_runs(spark, SF0001).repartition(5)
    append_run_records(runs, f"{tmpdir_run}/t", fmt="csv")
    append_run_records(runs, f"{tmpdir_run}/t", fmt="csv")
    parts = glob.glob(f"{tmpdir_run}/t/part-*")
    assert len(parts) == 10
    for part in parts:
        with open(part, newline="") as f:
            table = list(csv.reader(f))
        assert ",".join(table[0]) == HEADER and all(len(r) in (8, 11) for r in table[1:])
    assert read_run_history(spark, f"{tmpdir_run}/t").count() == 2 * runs.count()


def test_scaling_tables_scan_the_runs_once(spark, tmpdir_run):
    FX.fx_runs(spark, SF0001).write.parquet(f"{tmpdir_run}/runs")
    runs = spark.read.parquet(f"{tmpdir_run}/runs")

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans(H.run_groups(runs)) == 1
    for report in (H.strong_scaling(runs), H.strong_scaling(runs, same_n=False), H.amdahl(H.strong_scaling(runs))):
        assert scans(report) == 0 and report.count() > 0


def test_passes_of_parallel_seeding_do_not_depend_on_k(spark):
    pts = catalog.points(spark, SF0001).cache()
    pts.count()
    counts = []
    for k in (2, 60):
        with jobs(spark) as counted:
            seeds = kmeans_parallel(pts, k, key="id", rounds=3)
        counts.append(counted.count)
        assert len(set(seeds)) == k
    with jobs(spark) as counted:
        kmeanspp(pts, 12, key="id")
    assert abs(counts[1] - counts[0]) <= 4 and counted.count >= 12


def test_parallel_seeding_is_sound(spark):
    pts = catalog.points(spark, SF0001).cache()
    one, many = (kmeans_parallel(pts.repartition(n), 8, key="id", seed=3) for n in (1, 5))
    assert one == many
    cost = {init: fit_kmeans(pts, 8, 1, key="id", init=init).history[0]["wcss"] for init in ("kmeans||", "kmeans++")}
    assert cost["kmeans||"] < 1.5 * cost["kmeans++"]
    doubled = pts.withColumn("m", F.lit(2))
    assert kmeans_parallel(doubled, 4, key="id", multiplicity="m") == kmeans_parallel(pts, 4, key="id")
    few = spark.createDataFrame([(k, float(k % 3), 0.0) for k in range(30)], "id long, pickup_longitude double, pickup_latitude double")
    assert sorted(kmeans_parallel(few, 3)) == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]
    with pytest.raises(ValueError, match="distinct"):
        kmeans_parallel(few, 4)
    with pytest.raises(ValueError):
        kmeans_parallel(few.limit(0), 2)
    keyless = fit_kmeans(pts.drop("id"), 5, 3, init="kmeans||")
    assert sum(keyless.counts) == pts.count()
