"""Physical-plan checks: pushdown and pruning at the scan, no join of the points, bounded broadcasts."""

import os

from centroidal.operators.evaluate import centres_frame, cluster_sizes, result_rows
from centroidal.operators.assign import assign_nearest
from centroidal.operators.prepare import clean_points
from centroidal.operators.seed import kmeanspp_round_weight, weighted_draw
from centroidal.plans import catalog
from centroidal.sources.points import read_points

from conftest import SF0001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_box_filter_and_projection_reach_the_parquet_scan(spark, tmpdir_run):
    path = os.path.join(tmpdir_run, "pts")
    catalog.points(spark, SF0001).withColumn("extra", catalog.F.lit("x")).write.parquet(path)
    p = plan(clean_points(read_points(spark, path)))
    assert "PushedFilters: [IsNotNull(pickup_longitude), IsNotNull(pickup_latitude), " \
           "GreaterThanOrEqual(pickup_longitude" in p
    assert "ReadSchema: struct<pickup_longitude:double,pickup_latitude:double>" in p


def test_assignment_is_narrow(spark):
    pts = catalog.points(spark, SF0001)
    for method in ("arrow", "expr"):
        p = plan(assign_nearest(pts, catalog.CENTRES, method=method))
        assert "Exchange" not in p and "Join" not in p


def test_expr_assignment_stays_in_codegen(spark):
    pts = catalog.points(spark, SF0001)
    p = plan(assign_nearest(pts, catalog.CENTRES, method="expr"))
    assert "WholeStageCodegen" in p or "*(" in p


def test_reports_join_only_k_rows(spark):
    pts = catalog.points(spark, SF0001)
    a = assign_nearest(pts, catalog.CENTRES)
    p = plan(result_rows(a, centres_frame(spark, catalog.CENTRES)))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    sizes = plan(cluster_sizes(a, centres_frame(spark, catalog.CENTRES)))
    # The points are aggregated before the join.
    assert sizes.index("HashAggregate") > 0


def test_a_draw_computes_the_weight_once(spark):
    # a filter below the sort would run the UDF a second time, in a second Python worker of each task
    pts = catalog.points(spark, SF0001).withColumn("w", kmeanspp_round_weight(catalog.CENTRES))
    p = plan(weighted_draw(pts, "w").select(catalog.X, catalog.Y))
    assert p.count("ArrowEvalPython") == 1 and "TakeOrderedAndProject" in p


def test_a_draw_leaves_out_rows_without_weight_or_key(spark):
    df = spark.createDataFrame([(1, 0.0), (2, -1.0), (3, None), (None, 2.0), (4, 1.0)], "id long, w double")
    assert [r["id"] for r in weighted_draw(df, "w").collect()] == [4]
    assert weighted_draw(df.filter("id is null or id < 4"), "w").collect() == []
