"""Value semantics V1-V15 and the literal unit frames (FIXTURES.md FX8)."""

import math

import pytest
from pyspark.sql import functions as F

from centroidal.operators.assign import assign_nearest
from centroidal.operators.lloyd import fit_kmeans, lloyd_aggregate, lloyd_step
from centroidal.operators.prepare import clean_points, limit_points
from centroidal.sources.points import parse_point_lines

X, Y = "pickup_longitude", "pickup_latitude"
SCHEMA = "id bigint, pickup_longitude double, pickup_latitude double"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def test_box_is_inclusive_v1(spark):
    df = frame(spark, [(-75.0, 40.0), (-73.0, 41.5), (-75.0001, 40.0), (-73.0, 41.5001)])
    kept = sorted(r["id"] for r in clean_points(df, keep=["id"]).collect())
    assert kept == [0, 1]


def test_missing_and_nan_dropped_v2(spark):
    df = frame(spark, [(None, 40.0), (-74.0, None), (float("nan"), 40.0), (-74.0, 40.5)])
    kept = [r["id"] for r in clean_points(df, keep=["id"]).collect()]
    assert kept == [3]


def test_unparsable_text_becomes_null_v3(spark):
    lines = spark.createDataFrame([("0,0,0,0,0,-73.9abc,40.5",), ("0,0,0,0,0,-73.9,40.5",), ("0,0",)], "line string")
    rows = parse_point_lines(lines, "line").collect()
    assert rows[0][X] is None and rows[2][X] is None
    assert rows[1][X] == -73.9 and rows[1][Y] == 40.5


@pytest.mark.parametrize("method", ["arrow", "expr"])
def test_ties_go_to_lowest_id_v4(spark, method):
    # Points on x = -74.0 are equidistant from centres 0 and 2; on y = 40.75 from 0 and 1.
    centres = [(-74.5, 40.5), (-74.5, 41.0), (-73.5, 40.5), (-73.5, 41.0)]
    df = frame(spark, [(-74.0, 40.5), (-74.5, 40.75), (-74.0, 40.75), (-73.5, 40.75)])
    got = {r["id"]: r["cluster_id"] for r in assign_nearest(df, centres, method=method).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 2}


@pytest.mark.parametrize("method", ["partials", "arrow", "expr"])
def test_tie_rule_in_the_lloyd_pass(spark, method):
    centres = [(-74.5, 40.5), (-74.5, 41.0), (-73.5, 40.5), (-73.5, 41.0)]
    df = frame(spark, [(-74.0, 40.5), (-74.5, 40.75), (-74.0, 40.75), (-73.5, 40.75)])
    rows = {r["cluster_id"]: r["n"] for r in lloyd_aggregate(df, centres, method=method).collect()}
    assert rows == {0: 3, 2: 1}


def test_empty_cluster_keeps_centre_and_id_v5_v6(spark):
    centres = [(-74.5, 40.5), (-60.0, 10.0)]
    df = frame(spark, [(-74.4, 40.4), (-74.6, 40.6)])
    step = lloyd_step(df, centres)
    assert step.centres[1] == (-60.0, 10.0)
    assert step.counts == [2, 0]
    assert step.centres[0] == pytest.approx((-74.5, 40.5))


def test_first_iteration_moves_all_points_v7(spark):
    df = frame(spark, [(-74.0, 40.5), (-74.1, 40.6), (-73.9, 40.7)])
    m = fit_kmeans(df, 1, 5, key="id", init="kmeans++")
    assert m.history[0]["n_moved"] == 3
    assert m.history[-1]["n_moved"] == 0 and m.converged


def test_wcss_before_and_after_v8(spark):
    df = frame(spark, [(-74.0, 40.0), (-74.0, 41.0), (-73.0, 40.0), (-73.0, 41.0)])
    step = lloyd_step(df, [(-74.5, 40.5)])
    # Against (-74.5, 40.5): 2 * (0.25 + 0.25) + 2 * (2.25 + 0.25) = 6.0; against the mean (-73.5, 40.5): 4 * 0.5.
    assert step.wcss_before == pytest.approx(6.0)
    assert step.wcss_after == pytest.approx(2.0)


def test_stops_at_max_iter_and_recounts_v9_v10(spark):
    rows = [(-74.9 + 0.01 * i, 40.1 + 0.013 * (i % 37)) for i in range(200)]
    df = frame(spark, rows)
    m = fit_kmeans(df, 4, 2, key="id", init="kmeans++")
    assert m.iterations == 2
    total = sum(m.counts)
    assert total == 200
    # Counts come from the assignment to the final centres.
    a = assign_nearest(df, m.centres).groupBy("cluster_id").count().collect()
    assert {r["cluster_id"]: r["count"] for r in a} == {i: n for i, n in enumerate(m.counts) if n}


@pytest.mark.parametrize("max_rows,expected", [(-1, 8), (0, 8), (5, 5)])
def test_max_rows_limits_accepted_rows_v11(spark, max_rows, expected):
    df = frame(spark, [(-80.0, 40.5)] * 3 + [(-74.0, 40.5)] * 8)
    out = limit_points(clean_points(df, keep=["id"]), max_rows, order_by=["id"])
    assert out.count() == expected
    if max_rows == 5:
        assert [r["id"] for r in out.collect()] == [3, 4, 5, 6, 7]


def test_too_few_distinct_points_is_a_clear_error_v12(spark):
    df = frame(spark, [(-74.0, 40.5)] * 10)
    with pytest.raises(ValueError, match="distinct"):
        fit_kmeans(df, 3, 5, key="id", init="kmeans++")
    with pytest.raises(ValueError, match="distinct"):
        fit_kmeans(df, 3, 5, key="id", init="sample")
    m = fit_kmeans(df, 1, 5, key="id")
    assert m.centres == [(-74.0, 40.5)] and m.counts == [10]


def test_empty_input_raises_v13(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="no valid points"):
        fit_kmeans(df, 2, 5, key="id")


def test_max_iter_zero_v14(spark):
    df = frame(spark, [(-74.0, 40.5), (-73.5, 41.0), (-74.2, 40.1)])
    m = fit_kmeans(df, 2, 0, key="id", init="kmeans++")
    assert m.history == [] and m.centres == m.seeds and sum(m.counts) == 3


def test_one_point_k1(spark):
    df = frame(spark, [(-74.0, 40.5)])
    m = fit_kmeans(df, 1, 5, key="id")
    assert m.centres == [(-74.0, 40.5)]
    assert m.final_wcss == 0.0


def test_storage_level_exists_v15():
    from pyspark import StorageLevel
    assert StorageLevel.MEMORY_AND_DISK is not None
    assert not hasattr(StorageLevel, "MEMORY_AND_DISK_SER")


def test_exact_sums_are_order_independent(spark):
    # Values whose double sum depends on order; the micro-unit sum does not.
    vals = [(-74.1 + 1e-7 * (i % 13), 40.3 + 3e-7 * (i % 7)) for i in range(3000)]
    df = frame(spark, vals)
    a = lloyd_step(df.repartition(1), [(-74.0, 40.5)]).centres
    b = lloyd_step(df.repartition(7), [(-74.0, 40.5)]).centres
    c = lloyd_step(df.orderBy(F.desc("id")).repartition(3), [(-74.0, 40.5)]).centres
    assert a == b == c
    assert math.isclose(a[0][0], sum(v[0] for v in vals) / len(vals), abs_tol=1e-6)


def test_limit_keeps_the_least_keys(spark):
    from centroidal.plans import catalog
    from conftest import SF0001
    pts = catalog.points(spark, SF0001)
    ids = sorted(r["id"] for r in pts.select("id").collect())
    assert sorted(r["id"] for r in limit_points(pts.repartition(5), 300, order_by=["id"]).collect()) == ids[:300]
    assert limit_points(pts.repartition(4), 250).distinct().count() == 250
    assert limit_points(pts, 10 ** 9).count() == pts.count()
