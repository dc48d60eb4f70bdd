"""Sources and sinks: round trips in fresh scratch directories, readers on malformed input."""

import glob
import json
import os

from pyspark.sql import functions as F

from centroidal.operators.lloyd import fit_kmeans
from centroidal.operators.prepare import clean_points, zone_lookup, zone_unmatched
from centroidal.plans import catalog
from centroidal.sinks import writers as W
from centroidal.sources import fixtures as FX
from centroidal.sources.history import read_run_history
from centroidal.sources.points import (
    find_coordinate_columns, read_point_directory, read_points, read_positional_csv, union_point_sources,
)
from centroidal.sources.zones import read_zones

from conftest import SF0001

X, Y = "pickup_longitude", "pickup_latitude"


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_positional_csv_skips_header_short_and_bad_lines(spark, tmpdir_run):
    write(os.path.join(tmpdir_run, "a.csv"),
          "col_0,col_1,col_2,col_3,col_4,pickup_longitude,pickup_latitude\n"
          "0,0,0,0,0,-73.98,40.75\n0,0,0\n0,0,0,0,0,abc,40.1\n0,0,0,0,0,,40.2\n0,0,0,0,0,-74.01,40.71,extra\n")
    write(os.path.join(tmpdir_run, "b.csv"), "x\n0,0,0,0,0,-73.5,41.0\n")
    got = sorted((r[X], r[Y]) for r in clean_points(read_positional_csv(spark, tmpdir_run)).collect())
    assert got == [(-74.01, 40.71), (-73.98, 40.75), (-73.5, 41.0)]


def test_named_csv_and_parquet_sources(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "p.csv")
    write(p, "pickup_longitude,pickup_latitude\n-74.0,40.5\nbad,40.0\n")
    rows = clean_points(read_points(spark, p, "csv")).collect()
    assert [(r[X], r[Y]) for r in rows] == [(-74.0, 40.5)]
    pq = os.path.join(tmpdir_run, "pq")
    catalog.points(spark, SF0001).write.parquet(pq)
    assert read_points(spark, pq).count() == catalog.points(spark, SF0001).count()


def test_coordinate_discovery_and_union(spark):
    assert find_coordinate_columns(["id", "Start_Lon", "Start_Lat"]) == ("Start_Lon", "Start_Lat")
    assert find_coordinate_columns(["id", "fare"]) is None
    a = spark.createDataFrame([(-74.0, 40.5)], "lon double, lat double")
    b = spark.createDataFrame([(-73.0, 41.0)], "pickup_longitude double, pickup_latitude double")
    c = spark.createDataFrame([(1,)], "fare int")
    out, skipped = union_point_sources({"a": a, "b": b, "c": c})
    assert skipped == ["c"] and out.count() == 2


def test_zone_lookup_is_a_keyed_lookup(spark):
    trips, zones = FX.fx_trips(spark, SF0001), FX.fx_zones(spark)
    n = zone_lookup(trips, zones).count()
    twice = zones.unionByName(zones.withColumn("longitude", F.col("longitude") + 1))
    assert zone_lookup(trips, twice).count() == n
    assert sorted(zone_lookup(trips, twice).select("longitude").distinct().collect()) == \
        sorted(zone_lookup(trips, zones).select("longitude").distinct().collect())
    text = trips.withColumn("LocationID", F.col("LocationID").cast("string")).unionByName(
        trips.limit(3).withColumn("LocationID", F.lit("abc"))).unionByName(trips.limit(2).withColumn("LocationID", F.lit("")))
    assert zone_lookup(text, zones).count() == n and zone_unmatched(text, zones).count() == trips.count() - n + 5
    assert zone_unmatched(trips, zones).count() + n == trips.count()


def test_directory_with_differing_schemas(spark, tmpdir_run):
    d = os.path.join(tmpdir_run, "trips")
    spark.createDataFrame([(-74.0, 40.5)] * 5, "pickup_longitude double, pickup_latitude double").write.parquet(f"{d}/a")
    spark.createDataFrame([("-73.5", "41.0")] * 7, "start_lon string, start_lat string").write.parquet(f"{d}/b")
    spark.createDataFrame([(1,)], "fare int").write.parquet(f"{d}/c")
    points, skipped = read_point_directory(spark, d)
    assert points.count() == 12 and len(skipped) == 1
    assert {tuple(r) for r in points.select(X, Y).distinct().collect()} == {(-74.0, 40.5), (-73.5, 41.0)}


def test_preparation_command(spark, tmpdir_run, capsys):
    from centroidal.plans import prep
    d, out = os.path.join(tmpdir_run, "in"), os.path.join(tmpdir_run, "out")
    spark.createDataFrame([(1,), (2,), (99,)], "PULocationID int").coalesce(1).write.parquet(f"{d}/a")
    spark.createDataFrame([(2,), (None,)], "PULocationID bigint").coalesce(1).write.parquet(f"{d}/b")
    spark.createDataFrame([("1",), ("x",)], "PULocationID string").coalesce(1).write.parquet(f"{d}/c")
    zones = os.path.join(tmpdir_run, "zones.csv")
    write(zones, "LocationID,longitude,latitude\n1,-74.0,40.7\n2,-73.9,40.8\n2,-73.9,40.8\nx,1,1\n")
    assert prep.main([d, out, "--zones", zones]) == 0
    assert "7 rows read, 4 kept, 3 rejected" in capsys.readouterr().out
    points = read_positional_csv(spark, f"{out}/points").collect()
    assert sorted(tuple(r) for r in points) == [(-74.0, 40.7), (-74.0, 40.7), (-73.9, 40.8), (-73.9, 40.8)]
    profile = spark.read.parquet(f"{out}/profile").collect()
    assert sorted((r["raw_rows"], r["valid_rows"], r["is_total"]) for r in profile) == [
        (2, 1, False), (2, 1, False), (3, 2, False), (7, 4, True)]


def test_zone_reader(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "zones.csv")
    write(p, "LocationID,longitude,latitude\n1,-74.0,40.7\n2,,40.1\nx,-73.0,40.0\n")
    assert [r["LocationID"] for r in read_zones(spark, p).collect()] == [1]


def test_sinks_round_trip(spark, tmpdir_run):
    pts = catalog.points(spark, SF0001)
    m = fit_kmeans(pts, 3, 10, key="id")
    out = tmpdir_run
    W.write_assignments(m.predict(pts), f"{out}/assignments")
    back = spark.read.parquet(f"{out}/assignments")
    assert back.columns == [X, Y, "cluster_id"] and back.count() == pts.count()

    from centroidal.operators.evaluate import result_rows
    W.write_result_rows(result_rows(m.predict(pts), m.centres_frame(spark)), f"{out}/rows")
    line = open(sorted(glob.glob(f"{out}/rows/part-*.csv"))[0]).read().splitlines()
    assert line[0] == "x,y,cluster,centroid_x,centroid_y"
    assert all(len(v.split(".")[1]) == 6 for v in line[1].split(",") if "." in v)

    W.write_centroid_record(spark, m, f"{out}/centroids")
    rec = json.loads(open(glob.glob(f"{out}/centroids/part-*.json")[0]).read())
    assert rec["k"] == 3 and [c["id"] for c in rec["centroids"]] == [0, 1, 2]
    assert sum(c["count"] for c in rec["centroids"]) == pts.count()

    W.write_experiment_record(spark, m, f"{out}/experiments")
    W.write_experiment_record(spark, m, f"{out}/experiments")
    exp = spark.read.json(f"{out}/experiments")
    assert exp.count() == 2 and exp.first()["iterations"] == m.iterations
    assert len(exp.first()["per_iter_metrics"]["wcss"]) == m.iterations

    W.append_run_records(W.run_record(spark, m), f"{out}/metrics_csv", fmt="csv")
    W.append_run_records(W.run_record(spark, m), f"{out}/metrics_csv", fmt="csv")
    r = read_run_history(spark, f"{out}/metrics_csv")
    assert r.count() == 2 and r.first()["impl"] == "spark"
    for f in glob.glob(f"{out}/metrics_csv/part-*"):
        assert open(f).readline().startswith("impl,K,threads")
    W.append_run_records(W.run_record(spark, m), f"{out}/metrics_pq")
    assert spark.read.parquet(f"{out}/metrics_pq").count() == 1

    W.write_history(spark, m, f"{out}/history")
    assert spark.read.parquet(f"{out}/history").count() == m.iterations

    W.write_prepared_csv(pts, f"{out}/prepared")
    first = open(sorted(glob.glob(f"{out}/prepared/part-*.csv"))[0]).readline().strip()
    assert first == "col_0,col_1,col_2,col_3,col_4,pickup_longitude,pickup_latitude"
    assert clean_points(read_positional_csv(spark, f"{out}/prepared")).count() == pts.count()


def test_job_end_to_end(spark, tmpdir_run):
    from centroidal.plans.job import parse_args, run
    src = f"{tmpdir_run}/in"
    catalog.points(spark, SF0001).write.parquet(src)
    args = parse_args(["--input", src, "--format", "parquet", "--output", f"{tmpdir_run}/out", "--k", "4",
                       "--max_iter", "20", "--key", "id", "--n_parts", "3"])
    m = run(args, spark)
    a = spark.read.parquet(f"{tmpdir_run}/out/assignments")
    assert a.count() == m.n_points == sum(m.counts)
    counts = {r["cluster_id"]: r["count"] for r in a.groupBy("cluster_id").count().collect()}
    assert counts == {i: n for i, n in enumerate(m.counts) if n}
    assert spark.read.json(f"{tmpdir_run}/out/centroids").count() == 1


def test_job_with_zone_table_and_folding(spark, tmpdir_run):
    from centroidal.plans.job import parse_args, run
    trips = FX.fx_trips(spark, SF0001).withColumnRenamed("LocationID", "PULocationID")
    trips.write.parquet(f"{tmpdir_run}/trips")
    FX.fx_zones(spark).write.parquet(f"{tmpdir_run}/zones.parquet")
    args = parse_args(["--input", f"{tmpdir_run}/trips", "--format", "parquet", "--zones",
                       f"{tmpdir_run}/zones.parquet", "--output", f"{tmpdir_run}/out", "--k", "5", "--fold"])
    m = run(args, spark)
    joined = clean_points(zone_lookup(FX.fx_trips(spark, SF0001), FX.fx_zones(spark)), "longitude", "latitude")
    assert m.n_points == joined.count()
    assert spark.read.parquet(f"{tmpdir_run}/out/assignments").count() == joined.count()


def test_repartition_and_partition_profile(spark):
    from centroidal.operators.prepare import partition_profile, repartition_points
    pts = catalog.points(spark, SF0001)
    r = repartition_points(pts, 5)
    prof = partition_profile(r).collect()
    assert len(prof) == 5 and sum(p["rows"] for p in prof) == pts.count()
    assert repartition_points(pts, None) is pts


def test_number_formatting(spark):
    from centroidal.functions import formatting as fmt
    df = spark.createDataFrame([(1313.0, 2.6549, 33.2, 36830903.0, -73.9812345)], "a double, b double, c double, "
                                                                              "d double, e double")
    r = df.select(fmt.scientific("a").alias("s"), fmt.times("b").alias("t"), fmt.percent("c").alias("p"),
                  fmt.thousands("d").alias("th"), fmt.fixed("e", 6).alias("f")).first()
    assert (r["s"], r["t"], r["p"], r["th"], r["f"]) == ("1.3130e+03", "2.65x", "33.2%", "36,830,903", "-73.981235")


def test_job_discovers_coordinate_columns(spark, tmpdir_run):
    from centroidal.plans.job import parse_args, run
    src = f"{tmpdir_run}/older"
    catalog.points(spark, SF0001).withColumnRenamed("pickup_longitude", "Start_Lon") \
        .withColumnRenamed("pickup_latitude", "Start_Lat").write.parquet(src)
    m = run(parse_args(["--input", src, "--format", "parquet", "--output", f"{tmpdir_run}/out", "--k", "3",
                        "--key", "id"]), spark)
    assert m.n_points == catalog.points(spark, SF0001).count()


def test_named_csv_reads_columns_by_header_name(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "prepared.csv")
    write(p, "col_0,col_1,col_2,col_3,col_4,pickup_longitude,pickup_latitude\n0,0,0,0,0,-73.98,40.75\n"
             "0,0,0,0,0,-74.01,40.71\n")
    got = sorted((r[X], r[Y]) for r in clean_points(read_points(spark, p, "csv")).collect())
    assert got == [(-74.01, 40.71), (-73.98, 40.75)]


def test_zone_reader_by_name(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "zones2.csv")
    write(p, "Borough,latitude,LocationID,longitude\nQueens,40.7,3,-73.8\n")
    r = read_zones(spark, p).collect()
    assert [(z["LocationID"], z["longitude"], z["latitude"]) for z in r] == [(3, -73.8, 40.7)]
