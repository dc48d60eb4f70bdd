"""Boxes of points (X4, X5, J2): the same results as a full scan, fewer distances, nothing left behind."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from centroidal.operators.assign import assign_nearest, box_candidates, nearest_any, nearest_filtered, nearest_numpy, z_order
from centroidal.operators.blocks import pack_points
from centroidal.operators.lloyd import fit_kmeans, lloyd_step, packed_step
from centroidal.plans import catalog
from centroidal.session import ensure_checkpoint_dir, kept

from conftest import SF0001

X, Y = "pickup_longitude", "pickup_latitude"


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 300), st.integers(1, 700), st.integers(0, 3))
def test_filtered_search_equals_the_scan(seed, k, n, digits):
    rng = np.random.default_rng(seed)
    cx, cy = (np.round(rng.normal(size=k), digits) for _ in "xy")
    x, y = (np.round(rng.normal(size=n) * rng.choice([0.1, 1, 5]), digits) for _ in "xy")
    i, d = nearest_numpy(x, y, cx, cy)
    j, e, pairs = nearest_filtered(x, y, cx, cy)
    assert (i == j).all() and (d == e).all() and n <= pairs <= n * k


def test_missing_and_infinite_coordinates():
    cx, cy = np.arange(200.0), np.zeros(200)
    x = np.array([3.2, np.nan, np.inf, -np.inf, 7.0, 1e300])
    y = np.array([0.0, 1.0, 0.0, np.nan, np.nan, 0.0])
    i, d = nearest_any(x, y, cx, cy)
    assert i.tolist() == nearest_numpy(x, y, cx, cy)[0].tolist() and d[0] == nearest_numpy(x, y, cx, cy)[1][0]
    assert all(len(v) == 0 for v in nearest_any(x[:0], y[:0], cx, cy))


def test_candidates_hold_every_nearest_centre():
    rng = np.random.default_rng(2)
    cx, cy = rng.normal(size=(2, 90))
    for _ in range(200):
        x, y = rng.normal(size=(2, 30)) * rng.choice([0.05, 1]) + rng.normal(size=(2, 1))
        box = np.array([[x.min(), x.max(), y.min(), y.max()]])
        assert box_candidates(box, cx, cy)[0][nearest_numpy(x, y, cx, cy)[0]].all()


def test_neighbours_share_the_order():
    x, y = np.meshgrid(np.arange(64.0), np.arange(64.0))
    order = np.argsort(z_order(x.ravel(), y.ravel()), kind="stable").reshape(-1, 64)
    assert all(np.ptp(x.ravel()[o]) < 8 and np.ptp(y.ravel()[o]) < 8 for o in order)
    assert (z_order(np.full(5, 2.0), np.full(5, 3.0)) == 0).all()


@pytest.fixture(scope="module")
def pts(spark):
    return catalog.line_points(spark, SF0001).cache()


@pytest.mark.parametrize("k", [1, 5, 64, 300])
def test_packed_step_equals_a_full_step(spark, pts, k):
    rng = np.random.default_rng(k)
    centres, before = ([(float(a), float(b)) for a, b in zip(rng.uniform(-75, -73, k), rng.uniform(40, 41.5, k))] for _ in "ab")
    packed = pack_points(pts)
    for prev in (None, before):
        a, b = lloyd_step(pts, centres, prev), packed_step(packed, centres, prev)
        assert (a.centres, a.counts, a.n_moved) == (b.centres, b.counts, b.n_moved)
        assert abs(a.wcss_before - b.wcss_before) <= 1e-12 * a.wcss_before and b.pairs < pts.count() * k * 2 or k == 1


def test_weights_nulls_and_hot_places(spark):
    rows = [(-73.5, 40.5, 2)] * 3000 + [(-74.0 + i / 1000, 41.0, i % 5) for i in range(500)] + [(None, 40.0, 1), (float("nan"), 1.0, 2)]
    df = spark.createDataFrame(rows, f"{X} double, {Y} double, w long").repartition(3)
    centres = [(-73.5, 40.5), (-73.5, 40.5), (-73.9, 41.0), (-73.6, 41.0)]  # two in one place: the first takes all
    for weight in (None, "w"):
        a, b = lloyd_step(df, centres, centres[::-1], weight=weight), packed_step(pack_points(df, weight=weight), centres, centres[::-1])
        assert (a.centres, a.counts, a.n_moved) == (b.centres, b.counts, b.n_moved) and b.counts[1] == 0
    heavy = df.withColumn("w", F.lit(2 * 10 ** 11))
    a, b = lloyd_step(heavy, centres, weight="w"), packed_step(pack_points(heavy, weight="w"), centres)
    assert (a.centres, a.counts) == (b.centres, b.counts)
    with pytest.raises(Exception, match="negative"):
        packed_step(pack_points(df.withColumn("w", F.lit(-1)), weight="w"), centres)
    assert packed_step(pack_points(df.limit(0)), centres).counts == [0] * 4


def test_fit_by_boxes_equals_other_forms_and_counts_pairs(pts):
    seeds = fit_kmeans(pts, 20, 0, key="id").seeds
    fits = {m: fit_kmeans(pts.repartition(n), 20, 15, key="id", initial_centres=seeds, method=m) for m, n in (("blocks", 1), ("partials", 2))}
    a, b = fits["blocks"], fits["partials"]
    assert a.centres == b.centres and a.counts == b.counts and [h["n_moved"] for h in a.history] == [h["n_moved"] for h in b.history]
    scans = 2 * 20 * a.n_points  # the centres of this pass and of the one before
    assert all(0 < h["pairs"] < scans / 2 for h in a.history) and b.history[0]["pairs"] is None


def test_many_centres_through_the_frame(pts):
    rng = np.random.default_rng(4)
    centres = [(float(a), float(b)) for a, b in zip(rng.uniform(-75, -73, 1000), rng.uniform(40, 41.5, 1000))]
    rows = assign_nearest(pts, centres, dist_col="d").collect()
    x, y = (np.array([r[c] for r in rows]) for c in (X, Y))
    i, d = nearest_numpy(x, y, *np.array(centres).T)
    assert [r["cluster_id"] for r in rows] == i.tolist() and [r["d"] for r in rows] == d.tolist()


def test_means_are_the_plain_averages(spark, pts):
    """Centres come from coordinates in 10^-6 units; they lie within half a unit of the plain mean."""
    model = fit_kmeans(pts, 6, 3, key="id")
    previous = fit_kmeans(pts, 6, 2, key="id", initial_centres=model.seeds).centres
    for r in assign_nearest(pts, previous).groupBy("cluster_id").agg(F.avg(X).alias("x"), F.avg(Y).alias("y")).collect():
        cx, cy = model.centres[r["cluster_id"]]
        assert abs(cx - r["x"]) <= 5.1e-7 and abs(cy - r["y"]) <= 5.1e-7


def listed(spark) -> set[str]:
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {d for d in os.listdir(folder) if d.startswith(("points-", "packed-", "kept-"))}


def test_tables_and_caches_go_with_the_fit(spark, pts):
    before = listed(spark)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = fit_kmeans(pts, 4, 5, key="id", storage="checkpoint")
    assert sum(model.counts) == pts.count() and listed(spark) == before
    fit_kmeans(pts, 4, 5, key="id")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    with pytest.raises(ValueError):
        fit_kmeans(pts.limit(3), 4, 5, key="id", init="kmeans++", storage="checkpoint")
    assert listed(spark) == before
    with kept(pts, "checkpoint") as table:
        assert table.count() == pts.count() and len(listed(spark)) == len(before) + 1
    assert listed(spark) == before
