"""Streaming prediction, the SQL-registered nearest-centre function and per-file profiles."""

import os


from centroidal.operators.assign import assign_nearest, register_nearest_centre
from centroidal.operators.prepare import in_box, prep_profile
from centroidal.plans import catalog
from centroidal.sources.points import read_points, tag_files
from centroidal.streaming.predict import assign_stream, read_point_stream, write_assignment_stream

from conftest import SF0001


def test_stream_prediction_matches_batch(spark, tmpdir_run):
    src, out, ck = (os.path.join(tmpdir_run, d) for d in ("src", "out", "ck"))
    pts = catalog.FX.fx_points(spark, SF0001).select("pickup_longitude", "pickup_latitude")
    pts.repartition(3).write.parquet(src)
    q = write_assignment_stream(assign_stream(read_point_stream(spark, src), catalog.CENTRES), out, ck,
                                available_now=True)
    q.awaitTermination(120)
    streamed = spark.read.parquet(out)
    batch = assign_nearest(catalog.points(spark, SF0001), catalog.CENTRES)
    assert streamed.count() == batch.count()
    key = ["pickup_longitude", "pickup_latitude", "cluster_id"]
    assert streamed.select(*key).exceptAll(batch.select(*key)).count() == 0


def test_sql_function(spark):
    register_nearest_centre(spark, catalog.CENTRES)
    catalog.points(spark, SF0001).createOrReplaceTempView("pts")
    sql = spark.sql("SELECT id, nearest_centre(pickup_longitude, pickup_latitude) AS cluster_id FROM pts")
    api = assign_nearest(catalog.points(spark, SF0001), catalog.CENTRES).select("id", "cluster_id")
    assert sql.exceptAll(api).count() == 0 and sql.count() == api.count()


def test_profile_per_input_file(spark, tmpdir_run):
    d = os.path.join(tmpdir_run, "months")
    pts = catalog.FX.fx_points(spark, SF0001)
    pts.filter("id % 2 = 0").coalesce(1).write.parquet(os.path.join(d, "a"))
    pts.filter("id % 2 = 1").coalesce(1).write.parquet(os.path.join(d, "b"))
    files = [os.path.join(d, s) for s in ("a", "b")]
    tagged = tag_files(read_points(spark, files))
    prof = prep_profile(tagged, "file_tag", in_box()).collect()
    [total] = [r for r in prof if r["is_total"]]
    assert total["raw_rows"] == pts.count()
    assert total["valid_rows"] == catalog.points(spark, SF0001).count()
    assert len(prof) == 3
